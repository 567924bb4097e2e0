import math
import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit as A
from tidemark.operators.metadata import ACTION_HISTORY

RUNS = "database_schema string, table_name string, audit_id bigint, delta double"


def statistics(deltas):
    n, mean = len(deltas), sum(deltas) / len(deltas)
    squares = sum(abs(d - mean) ** 2 for d in deltas)
    spread = squares / n if n == 1 else squares / (n - 1)
    return mean, squares / n, spread, math.sqrt(spread)


def close(row, want):
    names = ("delta_avg", "delta_variance", "delta_std_deviation", "delta_stddev_sqrt")
    return all(math.isclose(row[c], w, rel_tol=1e-9, abs_tol=1e-9) for c, w in zip(names, want))


def test_hand_computed(spark):
    runs = spark.createDataFrame([("s", "t", i, d) for i, d in enumerate([5.0, None, 4.0], 1)], RUNS)
    rows = A.delta_stats(runs).orderBy("audit_id").collect()
    assert [(r["delta_avg"], round(r["delta_variance"], 4), r["delta_std_deviation"]) for r in rows] == [
        (5.0, 0.0, 0.0), (2.5, 6.25, 12.5), (3.0, 4.6667, 7.0),
    ]


@pytest.mark.parametrize("width", [1, 5, 50, 100_000])
def test_rolling_equals_brute_force_with_a_hot_table(spark, width):
    rng = random.Random(7)
    rows, history = [], defaultdict(list)
    for audit_id in range(1, 401):
        table = "hot" if rng.random() < 0.5 else f"t{rng.randrange(30)}"
        rows.append(("s", table, audit_id, rng.choice([None, 0.0, float(rng.randrange(100))])))
    want = {}
    for schema, table, audit_id, delta in rows:
        history[table].append(delta or 0.0)
        want[audit_id] = statistics(history[table][-7:])
    out = A.delta_stats(spark.createDataFrame(rows, RUNS), width=width).collect()
    assert len(out) == len(rows)
    assert all(close(r, want[r["audit_id"]]) for r in out)


def test_latest_is_the_last_rolling_row(spark):
    rng = random.Random(3)
    rows = [("s", f"t{rng.randrange(5)}", i, float(rng.randrange(50))) for i in range(100)]
    runs = spark.createDataFrame(rows, RUNS)
    by_table = defaultdict(list)
    for _, t, _, d in rows:
        by_table[t].append(d)
    for r in A.latest_stats(runs).collect():
        assert close(r, statistics(by_table[r["table_name"]][-7:])) and r["runs"] == min(7, len(by_table[r["table_name"]]))


def test_same_table_name_in_two_schemas_stays_apart(spark):
    runs = spark.createDataFrame([("a", "t", 1, 1.0), ("b", "t", 2, 9.0)], RUNS)
    assert {r["database_schema"]: r["delta_avg"] for r in A.latest_stats(runs).collect()} == {"a": 1.0, "b": 9.0}


@pytest.mark.parametrize("ranges", [1, 7, None, 3000])
def test_ids_are_dense_and_ordered(spark, ranges):
    df = spark.range(100).select((F.col("id") * 13 % 1009).alias("key"))
    rows = A.assign_ids(df, "key", base=50, ranges=ranges).orderBy("key").collect()
    assert [r["id"] for r in rows] == list(range(51, 151))


def test_status_changes_apply_in_order(spark):
    at = datetime(2024, 1, 1)
    actions = spark.createDataFrame([(i, "c", "s", "t", "u", at, None, 0) for i in (1, 2, 3)], ACTION_HISTORY)
    changes = spark.createDataFrame(
        [(1, 1, at, 1), (2, 2, at, -1), (2, 1, at, 1)],
        "action_id bigint, seq bigint, execution_end_datetime timestamp_ntz, execution_status bigint",
    )
    rows = A.current_actions(actions, changes).orderBy("action_id").collect()
    assert [(r["execution_status"], r["execution_end_datetime"] is None) for r in rows] == [(1, False), (-1, False), (0, True)]
    assert A.current_actions(actions, changes).columns == actions.columns


def test_ids_of_sparse_keys_and_without_rows(spark):
    # Half of the keys are neighbours, the others lie far apart, below zero too.
    df = spark.range(4000, numPartitions=7).select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise((F.col("id") - 2000) * 10**14).alias("key"), F.lit("x").alias("v"))
    got = A.assign_ids(df, "key").orderBy("key").collect()
    assert [r["id"] for r in got] == list(range(1, 4001)) and got[0].asDict().keys() == {"key", "v", "id"}
    assert A.assign_ids(df.limit(0), "key").count() == 0


def test_no_window_over_all_rows(spark):
    df = spark.range(1000, numPartitions=4).select(F.col("id").alias("key"))
    plan = A.assign_ids(df, "key")._jdf.queryExecution().executedPlan().toString()
    # The one window without a partitioning is over sums of blocks of ranges, after two aggregations.
    before = plan[plan.index("Exchange SinglePartition"):]
    assert plan.count("Exchange SinglePartition") == 1 and before.count("HashAggregate") >= 4
    runs = spark.range(1000).selectExpr("'s' AS database_schema", "'t' AS table_name", "id * 1000003 AS audit_id", "cast(id AS double) AS delta")
    assert "hashpartitioning(_b" in A.delta_stats(runs)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [2, 9, 100_000])
def test_rolling_statistics_of_one_table_with_sparse_ids(spark, width):
    rng = random.Random(13)
    ids = sorted(rng.sample(range(10**15), 600))
    rows = [("s", "hot" if i % 20 else f"t{i % 3}", n, float(rng.randrange(30))) for i, n in enumerate(ids)]
    history, want = defaultdict(list), {}
    for _, table, n, delta in rows:
        history[table].append(delta)
        want[n] = statistics(history[table][-7:])
    out = A.delta_stats(spark.createDataFrame(rows, RUNS), width=width).collect()
    assert len(out) == 600 and all(close(r, want[r["audit_id"]]) for r in out)
