from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from tidemark.functions import protect, scalar, sizes
from tidemark.functions.types import safe_cast, spark_type, struct_of
from tidemark.session import scratch, shared_root


def cast_all(spark, values, source, target):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", source)]))
    return [r[0] for r in df.select(safe_cast(F.col("x"), source, spark_type(target))).collect()]


@pytest.mark.parametrize(
    "values, source, target, expected",
    [
        (["12", " 7 ", "12.7", "1e3", "0x1F", "-0x10", "x", "", None], T.StringType(), "INT64", [12, 7, None, None, 31, -16, None, None, None]),
        (["9223372036854775808", "0xFFFFFFFFFFFFFFFF"], T.StringType(), "INT64", [None, None]),
        (["1.5", "1e3", "x", None], T.StringType(), "FLOAT64", [1.5, 1000.0, None, None]),
        (["TRUE", "false", "yes", "1", None], T.StringType(), "BOOL", [True, False, None, None, None]),
        ([1.5, 2.5, -0.5, 1e30, float("nan"), None], T.DoubleType(), "INT64", [2, 3, -1, None, None, None]),
        (["2024-01-31 10:00:00", "2024-02-31", None], T.StringType(), "DATETIME", [datetime(2024, 1, 31, 10), None, None]),
        (["1d", "1.5f", "2D ", "inf", "-2.5"], T.StringType(), "FLOAT64", [None, None, None, float("inf"), -2.5]),
        (["2024", "2024-01", "2024-01-31T10:00:00+05:00", "2024-01-31T10:00:00Z", "2024-1-3"], T.StringType(), "DATETIME", [None, None, None, None, datetime(2024, 1, 3)]),
        (["2024", "2024-01-31"], T.StringType(), "DATE", [None, date(2024, 1, 31)]),
        ([1, 0, None], T.LongType(), "BOOL", [True, False, None]),
        ([5, None], T.LongType(), "VARCHAR(50)", ["5", None]),
    ],
)
def test_safe_cast(spark, values, source, target, expected):
    assert cast_all(spark, values, source, target) == expected


def test_nested_value_becomes_json_text(spark):
    df = spark.sql("SELECT map('EUR', 0.9D) AS m")
    assert df.select(safe_cast(F.col("m"), df.schema["m"].dataType, T.StringType())).first()[0] == '{"EUR":0.9}'


def test_unknown_datatype():
    with pytest.raises(ValueError, match="GEOGRAPHY"):
        spark_type("GEOGRAPHY")


def test_struct_of():
    assert struct_of("a bigint, b string") == T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_epoch_ms(spark):
    df = spark.createDataFrame([("2024-01-31T00:00:00Z",), ("31.01.2024",), (None,)], "s string")
    assert [r[0] for r in df.select(scalar.epoch_ms(F.col("s"))).collect()] == [1706659200000, None, None]
    with pytest.raises(PySparkException):
        df.select(scalar.epoch_ms(F.col("s"), strict=True)).collect()


def test_epoch_units(spark):
    row = spark.range(1).select(
        scalar.epoch_to_timestamp(F.lit(1706659200000)).cast("string"),
        scalar.epoch_to_timestamp(F.lit(1706659200000), 1_000_000).cast("string"),
        scalar.epoch_to_timestamp(F.lit(1706659200), 1).cast("string"),
    ).first()
    # Milliseconds read as microseconds end up in January 1970.
    assert tuple(row) == ("2024-01-31 00:00:00", "1970-01-20 18:04:19.2", "2024-01-31 00:00:00")


@pytest.mark.parametrize("seconds, minutes", [(150, 2), (90, 2), (30, 0), (91, 2), (210, 4), (0, 0)])
def test_duration_rounds_halves_to_even(spark, seconds, minutes):
    start = scalar.ts_lit(datetime(2024, 1, 1))
    end = start + F.make_dt_interval(secs=F.lit(seconds))
    assert spark.range(1).select(scalar.duration_minutes(start, end)).first()[0] == minutes


def test_hash_share_is_stable_and_close(spark):
    df = spark.range(20_000)
    chosen = df.filter(scalar.hash_share(F.col("id"), 80))
    again = df.repartition(7).filter(scalar.hash_share(F.col("id"), 80))
    assert chosen.exceptAll(again).isEmpty() and again.exceptAll(chosen).isEmpty()
    assert 15_700 < chosen.count() < 16_300
    assert df.filter(scalar.hash_share(F.col("id"), 100)).count() == 20_000
    assert df.filter(scalar.hash_share(F.col("id"), 0)).count() == 0


def test_measured_bytes_bounds_the_rows(spark):
    df = spark.range(1000).withColumn("s", F.repeat(F.lit("x"), 100))
    assert 1000 * 108 <= sizes.measured_bytes(df) <= 1000 * 400
    assert sizes.broadcast_if_small(df, 10)[1] is False
    assert sizes.broadcast_if_small(df)[1] is True
    assert sizes.measured_bytes(df.limit(0)) == 0


# Made with: printf '<text + NUL padding>' | openssl enc -aes-128-cbc -nopad -K <key> -iv 3030...30
CIPHERS = {
    "hello": "9a06acfbf39975cde29d94b4f26682d1",
    "": "176c295a595d7193d095f1ce05665ab6",
}


def test_fixed_iv_format_is_the_stored_one(spark):
    key = "0123456789abcdef"
    df = spark.createDataFrame([(k,) for k in CIPHERS], "t string")
    for row in df.select("t", protect.encrypt_fixed_iv(F.col("t"), key).alias("c")).collect():
        assert row["c"] == CIPHERS[row["t"]]
    df = spark.createDataFrame([(v,) for v in CIPHERS.values()], "c string")
    assert {r[0] for r in df.select(protect.decrypt_fixed_iv(F.col("c"), key)).collect()} == set(CIPHERS)


@pytest.mark.parametrize("key", ["k" * 16, "k" * 24, "k" * 32])
@pytest.mark.parametrize("text", ["", "a", "exactly16bytes!!", "äöü € mixed", "x" * 100, None])
def test_both_ciphers_round_trip(spark, key, text):
    df = spark.createDataFrame([(text,)], "t string")
    t = F.col("t")
    row = df.select(
        protect.decrypt(protect.encrypt(t, key), key), protect.decrypt_fixed_iv(protect.encrypt_fixed_iv(t, key), key)
    ).first()
    assert tuple(row) == (text, text)


def test_random_nonce_and_bad_keys(spark):
    df = spark.createDataFrame([("a",), ("a",)], "t string").select(protect.encrypt(F.col("t"), "k" * 16).alias("c"))
    assert df.distinct().count() == 2
    with pytest.raises(ValueError, match="16, 24 or 32"):
        protect.encrypt(F.col("t"), "short")
    with pytest.raises(PySparkException):
        df.select(protect.decrypt(F.col("c"), "z" * 16)).collect()


def test_scratch_is_below_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch(spark, "x").startswith(named)
        assert shared_root(spark) == named.rstrip("/")
    assert scratch(spark, "x") != scratch(spark, "x")
