import pytest
from pyspark.sql import functions as F

from tidemark.operators import metadata as M
from tidemark.operators.staging import AUDIT_COLUMNS, projection, stage

HISTORY = [
    ("TIME", "INT64", "TIME"), ("DATE", "STRING", "DATE"), ("PRICEUSD", "FLOAT64", "PRICE_USD"),
    ("CIRCULATINGSUPPLY", "FLOAT64", "CIRCULATING_SUPPLY"),
]
TABLE = dict(project_id="P", database_schema="S", table_name="HISTORY")


def test_column_lists(spark):
    details = M.specs_of(spark, HISTORY, **TABLE)
    row = M.column_specs(details.orderBy("datatype")).first()
    assert row["create_columns"] == "time INT64, date STRING, price_usd FLOAT64, circulating_supply FLOAT64"
    assert row["cast_columns"].startswith("SAFE_CAST(time AS INT64) AS time, SAFE_CAST(date AS STRING) AS date, ")
    assert row["source_columns"] == "time, date, priceusd, circulatingsupply"
    assert row["target_columns"] == "time, date, price_usd, circulating_supply"


def test_unmapped_column_is_only_a_source(spark):
    row = M.column_specs(M.specs_of(spark, [("A", "STRING", "A"), ("B", "STRING", None)], **TABLE)).first()
    assert (row["source_columns"], row["target_columns"], row["create_columns"]) == ("a, b", "a", "a STRING")


def test_any_position_is_allowed(spark):
    details = M.specs_of(spark, [("A", "STRING", "A"), ("B", "INT64", "B"), ("C", "BOOL", "C")], **TABLE)
    odd = details.withColumn("ordinal_position", F.element_at(F.array(*map(F.lit, (1 << 40, 0, -5))), F.col("ordinal_position").cast("int")))
    assert M.column_specs(odd).first()["target_columns"] == "c, b, a"
    assert [s.target for s in M.compile_columns(odd, **TABLE)] == ["c", "b", "a"]


def test_compile_columns(spark):
    other = M.specs_of(spark, [("X", "STRING", "X")], project_id="P", database_schema="S", table_name="OTHER")
    specs = M.compile_columns(M.specs_of(spark, HISTORY, **TABLE).unionByName(other), **TABLE)
    assert [(s.source, s.target) for s in specs][2] == ("priceusd", "price_usd")
    with pytest.raises(ValueError, match="no column metadata"):
        M.compile_columns(other, **TABLE)


@pytest.mark.parametrize("rows", [
    [("TIME_LAST_UPDATE_UTC", "INT64", "TIME_LAST_UPDATE_UTC"), ("TIME_NEXT_UPDATE_UTC", "INT64", "TIME_LAST_UPDATE_UTC")],
    [("A", "BIGINT", "X"), ("B", "BIGINT", "x")],
])
def test_duplicate_targets_are_rejected(spark, rows):
    with pytest.raises(ValueError, match="two source columns"):
        M.compile_columns(M.specs_of(spark, rows, **TABLE), **TABLE)


def test_stage_matches_names_without_case_and_drops_the_rest(spark):
    from datetime import datetime

    specs = M.compile_columns(M.specs_of(spark, HISTORY, **TABLE), **TABLE)
    df = spark.createDataFrame([("1", "d", "2.5", "bad", "extra")], "time string, date string, priceUsd string, circulatingSupply string, more string")
    out = stage(df, specs, datetime(2024, 1, 1))
    assert out.columns == ["time", "date", "price_usd", "circulating_supply", *AUDIT_COLUMNS]
    assert out.first()[:4] == (1, "d", 2.5, None)
    with pytest.raises(ValueError, match="missing source column 'priceusd'"):
        projection(df.drop("priceUsd"), specs)


def test_ambiguous_source(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS A")
    with pytest.raises(ValueError, match="ambiguous"):
        projection(df, [M.ColumnSpec("a", "INT64", "a")])


def test_lookups(spark):
    config = spark.createDataFrame(
        [("PriceRegression", "4"), ("Other", "2")], "application_name string, executor_instances string"
    )
    assert M.lookup_ci(config, "application_name", "priceREGRESSION").count() == 1
    assert M.lookup(config, application_name="Other", executor_instances="4").count() == 0


def test_runtime_profile(spark):
    row = [1, "App", *["x"] * 8, 7, "C", "b", "f", None, None, None, None]
    profile = M.runtime_profile(spark.createDataFrame([tuple(row)], M.SPARK_CONFIG), "APP").first()
    assert profile["application_name"] == "App" and profile["source_file"] == "f"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_connection_details(spark, limit):
    connections = spark.createDataFrame([("a", "u1"), ("a", "u1"), ("b", "u2"), ("c", "u3")], "connection_name string, connection_url string")
    configs = spark.createDataFrame([("a", "t1"), ("a", "t1"), ("a", "t2"), ("b", "t1"), ("z", "t9")], "connection_name string, table_name string")
    rows = M.connection_details(connections, configs, ["connection_url"], ["table_name"], limit).collect()
    assert sorted(map(tuple, rows)) == [("a", "u1", "t1"), ("a", "u1", "t2"), ("b", "u2", "t1")]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_replace_by_key(spark, limit):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("c", 8)], "k string, v int")
    rows = M.replace_by_key(old, new, ["k"], limit).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("b", 3), (None, 4), ("a", 9), ("c", 8)], key=str)
