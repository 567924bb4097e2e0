import shutil
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.metadata import ColumnSpec
from tidemark.operators.staging import stamp
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming.incremental import stream_merge

SPECS = [ColumnSpec("id", "INT64", "id"), ColumnSpec("v", "INT64", "v")]


def test_each_file_is_merged_once(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path)
    table = SnapshotTable(spark, f"{root}/ref")

    def run():
        stream_merge(
            spark, landing, rows(0, 1, 0).schema, table, SPECS, "id", datetime(2024, 1, 1), f"{root}/checkpoint", files_per_batch=1
        )

    def rows(first, last, value):
        return spark.range(first, last, numPartitions=1).select("id", F.lit(value).cast("bigint").alias("v"))

    rows(0, 10, 1).write.mode("append").parquet(landing)
    rows(10, 20, 1).write.mode("append").parquet(landing)
    run()
    assert table.read().count() == 20
    run()
    published = table.latest()
    rows(5, 25, 2).write.mode("append").parquet(landing)
    run()
    assert table.latest() == published + 1
    assert {r["v"]: r["count"] for r in table.read().groupBy("v").count().collect()} == {1: 5, 2: 20}


def test_a_replayed_batch_is_skipped(spark, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    spark.range(5).select("id", F.col("id").alias("v")).coalesce(1).write.parquet(landing)
    table = SnapshotTable(spark, str(tmp_path / "ref"))
    # As after a crash between publishing batch 0 and noting it.
    table.publish(spark.createDataFrame([(0, 0)], "id bigint, v bigint"), tag=f"{checkpoint}#0")
    stream_merge(spark, landing, spark.read.parquet(landing).schema, table, SPECS, "id", datetime(2024, 1, 1), checkpoint)
    assert table.latest() == 1


def test_a_replay_after_a_compaction_leaves_rows_without_a_key_once(spark, tmp_path):
    landing, checkpoint, root = str(tmp_path / "landing"), str(tmp_path / "checkpoint"), str(tmp_path / "ref")
    batch = spark.createDataFrame([(1, 1), (None, 2), (None, 3)], "id bigint, v bigint").coalesce(1)
    batch.write.parquet(landing)

    def run(checkpoint):
        table = SnapshotTable(spark, root)
        stream_merge(spark, landing, batch.schema, table, SPECS, "id", datetime(2024, 1, 1), checkpoint)
        return table

    run(checkpoint)
    table = SnapshotTable(spark, root)
    table.publish(spark.createDataFrame([(9, 9)], "id bigint, v bigint").transform(lambda d: stamp(d, datetime(2024, 1, 1))), replace=[])
    assert table.compact(1000) == 3 and table.version().ledger == {checkpoint: 0}
    # The crash: the batch is published, but the checkpoint does not know it.
    shutil.rmtree(f"{checkpoint}/commits")
    again = run(checkpoint)
    assert again.latest() == 3
    assert sorted((r["id"] or 0, r["v"]) for r in again.read().collect()) == [(0, 2), (0, 3), (1, 1), (9, 9)]
    # Another stream into the same table has batches of its own.
    other = run(str(tmp_path / "other"))
    assert other.read().count() == 6 and set(other.version().ledger) == {checkpoint, str(tmp_path / "other")}
