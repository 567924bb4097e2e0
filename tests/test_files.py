import os

import pytest
from pyspark.errors import AnalysisException, PySparkException

from tidemark.functions.types import struct_of
from tidemark.plans.ingest import TableConfig
from tidemark.sources import files


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_header_and_null_markers(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'id,name\n1,"a,b"\n2,NA\n3,\n4,"say ""hi"""\n')
    df = files.read_delimited(spark, path)
    assert df.columns == ["id", "name"]
    assert rows(df) == [("1", "a,b"), ("2", None), ("3", None), ("4", 'say "hi"')]
    assert ("2", "NA") in rows(files.read_delimited(spark, path, null_markers=()))


def test_separators_by_format(spark, tmp_path):
    assert rows(files.read_landing(spark, put(tmp_path, "a.tsv", "x\ty\n1\t2\n"), "TSV")) == [("1", "2")]
    assert rows(files.read_landing(spark, put(tmp_path, "a.dat", "x;y\n1;2\n"), "dat", sep=";")) == [("1", "2")]


def test_no_header_and_own_quote(spark, tmp_path):
    path = put(tmp_path, "a.csv", "1,'a,b'\n2,'c'\n")
    df = files.read_delimited(spark, path, header="none", quote="'", columns=["id", "v"])
    assert rows(df) == [("1", "a,b"), ("2", "c")]


def test_leading_zeros_survive(spark, tmp_path):
    assert rows(files.read_delimited(spark, put(tmp_path, "a.csv", "zip\n007\n"))) == [("007",)]


def test_quoted_line_break_is_noticed(spark, tmp_path):
    broken = put(tmp_path, "a.csv", 'id,t\n1,"two\nlines"\n2,x\n')
    plain = put(tmp_path, "b.csv", 'id,t\n1,"one line"\n2,x\n')
    assert files._quoted_breaks(spark, broken, '"', "UTF-8")
    assert not files._quoted_breaks(spark, plain, '"', "UTF-8")
    assert rows(files.read_delimited(spark, broken)) == [("1", "two\nlines"), ("2", "x")]


@pytest.mark.parametrize("body, want", [
    ('1,"a\\"\nb\\""\n2,x\n', [("1", 'a"\nb"'), ("2", "x")]),
    ('1,"a\\"b"\n2,"c,\\"d"\n', [("1", 'a"b'), ("2", 'c,"d')]),
    ('1,"""quoted"""\n2,"x\n\ny"\n', [("1", '"quoted"'), ("2", "x\n\ny")]),
])
def test_escaped_quotes_and_line_breaks(spark, tmp_path, body, want):
    escape = "\\" if "\\" in body else None
    path = put(tmp_path, "a.csv", "id,t\n" + body)
    assert rows(files.read_delimited(spark, path, escape=escape)) == sorted(want, key=str)
    assert rows(files.rejected_records(spark, path, escape=escape)) == []


SURPLUS = 'id,t\n1,a,EXTRA\n2,"x,y"\n3\n4,"p,q","r\n5,6"\n7,b,\n8,5" pipe,6" pipe\n9,,,z\n'


@pytest.mark.parametrize("multiline", [None, True])
def test_surplus_values_are_rejected_or_fail(spark, tmp_path, multiline):
    path = put(tmp_path, "a.csv", SURPLUS)
    with pytest.raises(PySparkException, match="more than 2 values in a record: "):
        files.read_delimited(spark, path, multiline=multiline).collect()
    good = files.read_delimited(spark, path, multiline=multiline, on_surplus="reject")
    assert rows(good) == [("2", "x,y"), ("3", None)] and good.count() == 2 and rows(good.select("t")) == [("x,y",), (None,)]
    bad = files.rejected_records(spark, path, multiline=multiline)
    assert sorted(r["record"].strip() for r in bad.collect()) == ['1,a,EXTRA', '4,"p,q","r\n5,6"', "7,b,", '8,5" pipe,6" pipe', "9,,,z"]
    assert bad.count() == 5 and bad.filter("file LIKE '%a.csv'").count() == 5
    with pytest.raises(ValueError, match="on_surplus"):
        files.read_delimited(spark, path, on_surplus="drop")


def test_one_file_with_line_breaks_leaves_the_others_split(spark, tmp_path):
    for i in range(5):
        put(tmp_path, f"{i}.csv", f'id,t\n{i},"one"\n' + ('9,"two\nlines"\n' if i == 3 else ""))
    assert [f.rsplit("/", 1)[1] for f in files._quoted_breaks(spark, str(tmp_path), '"', "UTF-8")] == ["3.csv"]
    df = files.read_delimited(spark, str(tmp_path))
    assert rows(df) == [(str(i), "one") for i in range(4)] + [("4", "one"), ("9", "two\nlines")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_files_with_another_header_are_noticed(spark, tmp_path):
    put(tmp_path, "a.csv", "id,t\n1,x\n")
    put(tmp_path, "b.csv", "t,id\nx,1\n")
    with pytest.raises(Exception, match="header does not conform"):
        files.read_delimited(spark, str(tmp_path)).collect()


def test_empty_files(spark, tmp_path):
    assert rows(files.read_delimited(spark, put(tmp_path, "a.csv", "id,t\n"))) == []
    assert rows(files.read_delimited(spark, put(tmp_path, "b.csv", ""), header="none", columns=["a"])) == []


def test_config_options_reach_the_reader(spark, tmp_path):
    config = TableConfig("c", "s", "t", "FULL", file_format="CSV", delimiter="|", quote_characters="'")
    assert rows(config.file_source(spark, put(tmp_path, "a.csv", "a|b\n'x|y'|2\n"))) == [("x|y", "2")]


RESPONSE = '{"data": [{"id": "btc", "priceUsd": 1.5, "rates": {"EUR":0.9}}, {"ID": "eth", "rank": 2}], "timestamp": 1}'


def test_response_with_metadata_names(spark, tmp_path):
    df = files.read_json_response(spark, put(tmp_path, "r.json", RESPONSE), ["ID", "PRICEUSD", "RATES", "RANK"])
    assert df.columns == ["id", "priceusd", "rates", "rank"]
    assert rows(df) == [("btc", "1.5", '{"EUR":0.9}', None), ("eth", None, None, "2")]


def test_response_inferred_has_the_union_of_names(spark, tmp_path):
    path = put(tmp_path, "r.json", '{"data": [{"a": 1}, {"b": "x"}]}')
    assert rows(files.read_json_response(spark, path)) == [(1, None), (None, "x")]


def test_response_without_data(spark, tmp_path):
    path = put(tmp_path, "r.json", '{"error": "limit"}')
    with pytest.raises(ValueError, match="no data array"):
        files.read_json_response(spark, path)
    with pytest.raises(PySparkException, match="no data array"):
        files.read_json_response(spark, path, ["a"]).collect()


def test_json_lines_with_and_without_schema(spark, tmp_path):
    path = put(tmp_path, "l.json", '{"a": 1}\n{"a": 2}\n')
    assert rows(files.read_landing(spark, path, "JSON")) == [(1,), (2,)]
    assert rows(files.read_landing(spark, path, "JSON", schema="a string")) == [("1",), ("2",)]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="XLSX"):
        files.read_landing(spark, "x", "XLSX")


def test_external_view_is_replaced(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    spark.range(5).write.parquet(str(tmp_path / "b"))
    files.external_view(spark, "ext", str(tmp_path / "a"))
    assert files.external_view(spark, "ext", str(tmp_path / "b")).count() == 5
    assert spark.sql("SELECT count(*) FROM ext").first()[0] == 5


def test_codec(spark, tmp_path):
    files.write_parquet(spark.range(3), str(tmp_path / "z"), "GZIP")
    assert any(f.endswith(".gz.parquet") for f in os.listdir(tmp_path / "z"))


def test_write_modes_and_declared_schema(spark, tmp_path):
    path, schema = str(tmp_path / "t"), struct_of("a bigint, b string")
    df = spark.sql("SELECT 'x' AS b, '1' AS a, 9 AS extra UNION ALL SELECT 'y', 'bad', 9")
    files.write_table(df, path, schema)
    with pytest.raises(AnalysisException):
        files.write_table(df, path, schema, "fail")
    files.write_table(df, path, schema, "append")
    assert spark.read.parquet(path).schema == schema
    assert rows(spark.read.parquet(path)) == [(1, "x"), (1, "x"), (None, "y"), (None, "y")]
    files.write_table(df.limit(1), path, schema, "replace")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        files.write_table(df, path, schema, "upsert")


def test_archive(spark, tmp_path):
    landing, archive = str(tmp_path / "landing"), str(tmp_path / "archive")
    assert files.archive_landing(spark, landing, archive, "20240101") is False
    files.write_parquet(spark.range(3), landing)
    assert files.archive_landing(spark, landing, archive, "20240101") is True
    files.write_parquet(spark.range(9), landing, mode="overwrite")
    assert files.archive_landing(spark, landing, archive, "20240102") is True
    kept = {r["archived_at"]: r["count"] for r in spark.read.parquet(archive).groupBy("archived_at").count().collect()}
    assert kept == {20240101: 3, 20240102: 9}


def test_one_row(spark):
    from datetime import datetime

    row = files.one_row(spark, struct_of("a bigint, t timestamp_ntz, s string"), (1, datetime(2024, 1, 1, 2), None))
    assert tuple(row.first()) == (1, datetime(2024, 1, 1, 2), None)


ODD = {
    "data": [
        {"id": 1, "a b": "x", "n": 1.5, "o": {"k": [1, 2]}, "m": 1, 'q"t': True, "z": None, "it's \"q": 5, "price": "1.5"},
        {"id": 2, "n": 7, "m": "text", "arr": [1, {"b": 2}], "we,ird": 3, "co:lon": {"a,b": "c:d"}, "tick`s": 1, "big": 1e300},
        {"id": 3, "m": {"deep": None}, "o": "flat", "a.b": "dot", "n": None},
        {},
    ]
}


def test_variant_response_has_the_union_of_names(spark, tmp_path):
    import json

    df = files.read_variant_response(spark, put(tmp_path, "r.json", json.dumps(ODD)))
    got = sorted((r.asDict() for r in df.collect()), key=lambda r: r["id"] or 9)
    names = sorted({k for r in ODD["data"] for k in r})
    assert sorted(df.columns) == names
    types = dict(df.dtypes)
    assert (types["id"], types["n"], types['q"t'], types["big"], types["m"], types["price"]) == ("bigint", "double", "boolean", "double", "string", "string")
    text = lambda v: json.dumps(v, separators=(",", ":")) if isinstance(v, (dict, list)) else v
    for row, record in zip(got, ODD["data"]):
        want = {n: text(record.get(n)) for n in names}
        want["m"] = None if want["m"] is None else str(want["m"])
        assert row == want


def test_variant_responses_by_line_with_a_given_shape(spark, tmp_path):
    path = put(tmp_path, "r.json", '{"data": [{"a": 1}, {"b": "x"}]}\n\n{"data": []}\n{"data": [{"a": "2"}]}\n')
    assert rows(files.read_variant_response(spark, path, multiline=False)) == [("1", None), ("2", None), (None, "x")]
    shape = struct_of("a bigint, c double")
    assert rows(files.read_variant_response(spark, path, multiline=False, shape=shape)) == [(1, None), (2, None), (None, None)]


@pytest.mark.parametrize("text, problem", [
    ('{"error": 1}', "no data array"), ('{"data": [1, 2]}', "no objects"), ('{"data": [{"a": 1, "A": 2}]}', "only by case"), ('{"data": [', "(?i)malformed|json"),
])
def test_variant_responses_that_are_none(spark, tmp_path, text, problem):
    with pytest.raises(Exception, match=problem):
        files.read_variant_response(spark, put(tmp_path, "r.json", text)).collect()


def test_variant_response_without_records(spark, tmp_path):
    assert files.read_variant_response(spark, put(tmp_path, "r.json", '{"data": []}')).columns == []
