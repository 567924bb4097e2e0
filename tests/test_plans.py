"""What the physical plans must look like to hold at scale."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit as A, extract as X, load as L, metadata as M
from tidemark.operators.staging import stage, stamp
from tidemark.plans import catalog


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def test_incremental_bounds_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(X.incremental(events, "ts", datetime(2024, 1, 20), datetime(2024, 1, 21)).select("value"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def test_staging_reads_only_mapped_columns_without_a_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(stage(events, [M.ColumnSpec("VALUE", "INT64", "v")], datetime(2024, 1, 1)))
    assert "ReadSchema: struct<value:double>" in plan and "Exchange" not in plan


def merged(orders, limit):
    source = orders.filter("o_orderdate >= TIMESTAMP_NTZ '2001-06-01'")
    return plan_of(L.merge_upsert(stamp(orders, datetime(2024, 1, 1)), source, "o_orderkey", datetime(2024, 2, 1), broadcast_bytes=limit))


def test_small_source_never_moves_the_target(orders):
    plan = merged(orders, 1 << 26)
    # The one shuffle is of the matched keys, which the source bounds.
    shuffles = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)
    assert len(shuffles) <= 1 and "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_large_source_is_joined_by_shuffle_with_the_target_on_the_left(orders):
    orders.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged(orders, 0)
    finally:
        orders.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "LeftOuter" in plan and "LeftAnti" in plan and "FullOuter" not in plan


def test_latest_runs_are_limited_before_the_shuffle(orders):
    runs = orders.select(
        F.col("o_orderstatus").alias("database_schema"), F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderkey").alias("audit_id"), F.col("o_totalprice").alias("delta"),
    )
    plan = plan_of(A.latest_stats(runs))
    assert plan.index("Final") < plan.index("Exchange") < plan.rindex("Partial")


def test_rolling_windows_are_cut_by_range(orders):
    runs = orders.select(
        F.col("o_orderstatus").alias("database_schema"), F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderkey").alias("audit_id"), F.col("o_totalprice").alias("delta"),
    )
    plan = plan_of(A.delta_stats(runs))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    rows_move_by = [k for k in keys if "_b#" in k]
    # Ranges of ranks: no window gathers a table, nor all rows but the sums of blocks of ranges.
    assert rows_move_by and all("_b#" in k for k in keys if "table_name" in k)


def test_resample_and_watermark_combine_before_the_shuffle(spark, sf_dir):
    for name in ("extract_watermark", "extract_resample_hourly", "audit_record_count"):
        plan = plan_of(catalog.queries()[name](spark, sf_dir))
        assert "partial_" in plan


def test_top_rows_are_taken_without_a_global_sort(spark, sf_dir):
    plan = plan_of(catalog.queries()["src_limit10"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_no_python_in_any_plan(spark, sf_dir):
    for name in ("load_merge", "audit_delta_stats", "feat_calendar", "lr_predictions", "protect_fixed_iv_roundtrip", "stage_typed"):
        plan = plan_of(catalog.queries()[name](spark, sf_dir))
        assert "Python" not in plan and "Pandas" not in plan, name


def test_no_cross_joins(spark, sf_dir):
    for name in ("audit_latest7", "load_merge", "load_plan", "meta_connection_details"):
        plan = plan_of(catalog.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
