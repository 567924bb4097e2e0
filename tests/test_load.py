from collections import Counter
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import load as L
from tidemark.operators.staging import AUDIT_COLUMNS, stamp
from tidemark.session import ADVISORY, prepare

OLD, NOW = datetime(2024, 1, 1), datetime(2024, 2, 1)
SCHEMA = "k bigint, v bigint, w string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


def expected(target, source):
    """The meaning of the upsert, row by row."""
    by_key = {}
    for row in source:
        if row[0] is not None:
            by_key.setdefault(row[0], []).append(row)
    keys = {k for k, *_ in target if k is not None}
    if any(len(rows) > 1 and k in keys for k, rows in by_key.items()):
        return None
    out = []
    for row in target:
        hit = by_key.get(row[0])
        out.append((*(hit[0] if hit else row), False, False, OLD, OLD))
    out += [(*row, False, False, NOW, NOW) for row in source if row[0] is None or row[0] not in keys]
    return Counter(out)


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3), st.sampled_from(["a", None])), max_size=10)


@pytest.mark.parametrize("limit", [0, 1 << 20])
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=ROWS, source=ROWS)
def test_merge_equals_its_meaning(spark, limit, target, source):
    want = expected(target, source)
    t = stamp(frame(spark, target), OLD)
    if want is None:
        with pytest.raises(L.DuplicateSourceKey):
            L.merge_upsert(t, frame(spark, source), "k", NOW, broadcast_bytes=limit)
        return
    got = L.merge_upsert(t, frame(spark, source), "k", NOW, broadcast_bytes=limit)
    assert got.columns == ["k", "v", "w", *AUDIT_COLUMNS]
    assert Counter(map(tuple, got.collect())) == want


def test_repeated_keys_without_a_match_are_all_inserted(spark):
    t = stamp(frame(spark, [(1, 1, "a")]), OLD)
    out = L.merge_upsert(t, frame(spark, [(2, 1, "a"), (2, 2, "b")]), "k", NOW)
    assert out.count() == 3


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_latest_policy(spark, limit):
    t = stamp(frame(spark, [(1, 0, "old"), (3, 0, "keep")]), OLD)
    s = frame(spark, [(1, 5, "x"), (1, 7, "y"), (1, 7, "z"), (2, 1, "n"), (2, 2, "m"), (None, 1, "p"), (None, 2, "q")])
    out = L.merge_upsert(t, s, "k", NOW, on_duplicate="latest", latest_by=["v"], broadcast_bytes=limit)
    got = sorted((r["k"] or 0, r["v"], r["w"]) for r in out.collect())
    assert got == [(0, 1, "p"), (0, 2, "q"), (1, 7, "z"), (2, 2, "m"), (3, 0, "keep")]


def test_update_keeps_or_touches_the_load_time(spark):
    t, s = stamp(frame(spark, [(1, 0, "a")]), OLD), frame(spark, [(1, 1, None)])
    kept = L.merge_upsert(t, s, "k", NOW).first()
    touched = L.merge_upsert(t, s, "k", NOW, touch_load_ts=True).first()
    assert (kept["v"], kept["w"], kept["dw_load_datetime"]) == (1, None, OLD)
    assert (touched["dw_create_datetime"], touched["dw_load_datetime"]) == (OLD, NOW)


@pytest.mark.parametrize("change", [lambda df: df.withColumn("x", F.lit(1)), lambda df: df.drop("w"), lambda df: df.withColumn("v", F.lit("1"))])
def test_another_shape_is_an_error(spark, change):
    t = stamp(frame(spark, [(1, 0, "a")]), OLD)
    with pytest.raises(ValueError, match="differ in [xwv];"):
        L.merge_upsert(t, change(frame(spark, [(1, 1, "b")])), "k", NOW)


def test_composite_key(spark):
    t = stamp(frame(spark, [(1, 1, "a"), (1, 2, "b")]), OLD)
    out = L.merge_upsert(t, frame(spark, [(1, 2, "c"), (1, 3, "d")]), ["k", "v"], NOW)
    assert sorted((r["v"], r["w"]) for r in out.collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_hot_key_in_the_target(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("k"), F.lit(0).cast("bigint").alias("v"), F.lit("t").alias("w"))
    out = L.merge_upsert(stamp(hot, OLD), frame(spark, [(7, 1, "s")]), "k", NOW, broadcast_bytes=0)
    assert out.filter("k = 7 AND v = 1").count() == 1000 and out.count() == 3000


def test_hot_key_in_the_source_is_reduced_before_it_moves(spark):
    s = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("k"), F.col("id").alias("v"), F.lit("s").alias("w"))
    out = L.latest_per_key(s, ["k"], ["v"])
    assert out.count() == 2001 and out.filter("k = 7").first()["v"] == 2997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") >= 1 and "Window" not in plan


@pytest.mark.parametrize(
    "exists, load_type, key, override, action",
    [
        (False, "INCR", "k", None, "create"), (False, "FULL", None, None, "create"), (True, "FULL", None, None, "full_refresh"),
        (True, "INCR", "k", None, "merge"), (True, "INCR", "k", "FULL", "full_refresh"), (True, "FULL", "k", "INCR", "merge"),
        (True, "INCR", None, None, "reject"), (True, "SNAP", "k", None, "reject"), (True, "INCR", "", None, "reject"),
        (False, "INCR", None, None, "reject"), (False, "SNAP", "k", None, "reject"), (False, "FULL", None, "INCR", "reject"),
    ],
)
def test_route_and_plan_agree(spark, exists, load_type, key, override, action):
    configs = spark.createDataFrame([("s", "t", load_type, key, override)], "database_schema string, table_name string, load_type string, primary_key_column string, load_type_override string")
    state = spark.createDataFrame([("s", "t", 1)] if exists else [], "database_schema string, table_name string, table_exists int")
    assert L.load_plan(configs, state).first()["action"] == action
    if action == "reject":
        with pytest.raises(ValueError):
            L.route(exists, load_type, key, override)
    else:
        assert L.route(exists, load_type, key, override) == action


@pytest.mark.parametrize("given, used", [(None, "16m"), ("64MB", "16m"), (str(1 << 30), "16m"), ("8m", "8m")])
def test_sorted_partitions_are_bounded(spark, given, used):
    """The sorts of a merge take a task's memory by the size of a partition, whoever has set it."""
    before = spark.conf.get(ADVISORY)
    try:
        spark.conf.unset(ADVISORY) if given is None else spark.conf.set(ADVISORY, given)
        prepare(spark)
        assert spark.conf.get(ADVISORY) == used
    finally:
        spark.conf.set(ADVISORY, before)
