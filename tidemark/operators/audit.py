"""Action history, audit rows and the statistics of record-count deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalar import duration_minutes
from tidemark.session import scratch

# Status of a workflow action.
IN_PROGRESS, COMPLETE, FAILED = 0, 1, -1
LAST_RUNS = 7
#: Consecutive ranks that one task of the rolling statistics takes.
RANGE = 100_000
#: Partitions whose counts are summed up together before the sums of such blocks are.
BLOCK = 1024


def ranked(df: DataFrame, order: Sequence[str], name: str, base: int = 0, ranges: int | None = None) -> DataFrame:
    """The rows with dense ranks ``base + 1, base + 2, ...`` in the given order.

    Rows are sorted into ranges that a sample cuts to equal sizes, whatever the values are, and
    written with their place in their range. What is summed up is one count per range, in two
    levels: within blocks of ranges, then over blocks. The written table makes ranges and
    places the same for the counts and for the rows, also when a task runs again. ``ranges``
    is their number, the session's shuffle partitions by default.
    """
    spark = df.sparkSession
    path = scratch(spark, "ranked")
    # The number of a sorted partition and the place in it.
    cut = order if ranges is None else [ranges, *order]
    placed = df.repartitionByRange(*cut).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).withColumn("_r", F.shiftright("_m", 33))
    counts = rows.groupBy("_r").agg(F.count(F.lit(1)).alias("_n")).withColumn("_k", F.floor(F.col("_r") / BLOCK))
    within = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("_k").agg(F.sum("_n").alias("_n"))
    over = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select("_k", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_begin"))
    offsets = (
        counts.withColumn("_inside", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(begins, "_k")
        .select("_r", (F.col("_begin") + F.col("_inside")).alias("_offset"))
    )
    place = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per range: as many as the session has shuffle partitions.
    return (
        rows.join(F.broadcast(offsets), "_r")
        .withColumn(name, (F.lit(base + 1) + F.col("_offset") + place).cast("bigint"))
        .drop("_m", "_r", "_offset")
    )


def assign_ids(df: DataFrame, order: str, base: int = 0, name: str = "id", ranges: int | None = None) -> DataFrame:
    """Dense ids ``base + 1, base + 2, ...`` in the order of a unique column."""
    return ranked(df, [order], name, base, ranges)


def open_actions(runs: DataFrame, order: str, base: int = 0) -> DataFrame:
    """New action rows, status 0, with ids given out by this one writer."""
    return assign_ids(runs, order, base, "action_id").withColumns(
        {
            "execution_end_datetime": F.lit(None).cast("timestamp_ntz"),
            "execution_status": F.lit(IN_PROGRESS).cast("bigint"),
        }
    )


def current_actions(actions: DataFrame, changes: DataFrame) -> DataFrame:
    """Actions with the end and status of their last change.

    ``changes`` is append-only: action_id, seq, execution_end_datetime,
    execution_status. The last ``seq`` wins; the rest breaks ties.
    """
    last = changes.groupBy("action_id").agg(
        F.max(F.struct("seq", "execution_end_datetime", "execution_status")).alias("_last")
    )
    taken = F.col("_last").isNotNull()
    return actions.join(last, "action_id", "left").select(
        *[
            F.when(taken, F.col(f"_last.{c}")).otherwise(F.col(c)).alias(c)
            if c in ("execution_end_datetime", "execution_status")
            else F.col(c)
            for c in actions.columns
        ]
    )


def finalize(audit: DataFrame, actions: DataFrame, counts: DataFrame) -> DataFrame:
    """Close audit rows: end time of the action, count after, duration and delta.

    ``counts`` holds action_id and record_cnt_after. All three are unique on
    action_id and arrive partitioned by it once.
    """
    computed = {
        "execution_duration": duration_minutes(
            F.col("execution_start_datetime"), F.col("execution_end_datetime")
        ),
        "delta": (F.col("record_cnt_after") - F.col("record_cnt_before")).cast("double"),
    }
    replaced = ("execution_end_datetime", "record_cnt_after", *computed)
    return (
        audit.drop(*replaced)
        .join(actions.select("action_id", "execution_end_datetime"), "action_id", "left")
        .join(counts.select("action_id", "record_cnt_after"), "action_id", "left")
        .withColumns(computed)
    )


def _statistics(n: Column, mean: Column, population: Column, sample: Column) -> dict[str, Column]:
    # The column called standard deviation holds the sample variance (the
    # population one for a single run); the root is a column of its own.
    spread = F.when(n == 1, population).otherwise(sample)
    return {
        "delta_avg": mean,
        "delta_variance": population,
        "delta_std_deviation": spread,
        "delta_stddev_sqrt": F.sqrt(spread),
    }


def delta_stats(
    audit: DataFrame,
    tables: Sequence[str] = ("database_schema", "table_name"),
    order: str = "audit_id",
    last: int = LAST_RUNS,
    width: int = RANGE,
) -> DataFrame:
    """Statistics of the last ``last`` deltas as of every run of every table.

    A table may own any share of the runs, so the runs are ranked by table and order, and a task
    takes ``width`` consecutive ranks. Each range also gets the ``last - 1`` ranks before it
    (its halo), so its frames are whole; a frame never leaves its table.
    """
    tables, halo = list(tables), last - 1
    runs = audit.select(*tables, order, F.coalesce("delta", F.lit(0.0)).alias("_delta"))
    rows = ranked(runs, [*tables, order], "_rank")
    first, reach = (F.floor((F.col("_rank") + n) / F.lit(width)).cast("bigint") for n in (0, halo))
    spread = rows.withColumn("_own", first).withColumn("_b", F.explode(F.sequence(first, reach)))
    frame = Window.partitionBy("_b", *tables).orderBy("_rank").rowsBetween(-halo, 0)
    stats = _statistics(
        F.count("_delta").over(frame),
        F.avg("_delta").over(frame),
        F.var_pop("_delta").over(frame),
        F.var_samp("_delta").over(frame),
    )
    return (
        spread.select(*tables, order, "_b", "_own", *[c.alias(n) for n, c in stats.items()])
        .filter(F.col("_b") == F.col("_own"))
        .drop("_b", "_own")
    )


def latest_stats(
    audit: DataFrame,
    tables: Sequence[str] = ("database_schema", "table_name"),
    order: str = "audit_id",
    last: int = LAST_RUNS,
) -> DataFrame:
    """Statistics of the newest ``last`` runs of every table.

    The rank limit is applied per map task before the shuffle, which leaves at most
    ``last`` rows per table and task to move.
    """
    newest = Window.partitionBy(*tables).orderBy(F.desc(order))
    kept = (
        audit.select(*tables, order, "delta")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= last)
    )
    return kept.groupBy(*tables).agg(
        F.max(order).alias(order), F.count(F.lit(1)).alias("runs"), *delta_columns()
    )


def delta_columns() -> list[Column]:
    """The statistics over a group of runs, as aggregates of ``delta`` (NULL counts as 0)."""
    delta = F.coalesce("delta", F.lit(0.0))
    stats = _statistics(F.count(delta), F.avg(delta), F.var_pop(delta), F.var_samp(delta))
    return [c.alias(n) for n, c in stats.items()]
