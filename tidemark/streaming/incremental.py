"""The incremental load as a stream: new landing files are merged batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.operators.load import latest_per_key
from tidemark.operators.metadata import ColumnSpec
from tidemark.operators.staging import stage
from tidemark.plans.ingest import load_reference
from tidemark.sources.snapshots import SnapshotTable


def stream_merge(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: SnapshotTable,
    specs: Sequence[ColumnSpec],
    keys: str | Sequence[str],
    load_ts: datetime,
    checkpoint: str,
    files_per_batch: int = 100,
    watermark: str | None = None,
    **merge_options: Any,
) -> None:
    """Merge every file of ``landing`` that no earlier run has seen, then stop.

    A batch that was published but not yet noted in the checkpoint comes again after
    a crash. Every version keeps the last batch of each checkpoint, so it is skipped also
    where a compaction or another load was published in between. Late rows need no watermark: the
    key-based upsert takes them whenever they arrive.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        current = table.version()
        if current is not None and current.has_batch(tag):
            return
        staged = stage(batch, specs, load_ts)
        action = "create" if current is None else "merge"
        if current is None and merge_options.get("on_duplicate") == "latest":
            staged = latest_per_key(staged, [keys] if isinstance(keys, str) else keys, merge_options["latest_by"])
        load_reference(table, staged, action, load_ts, keys, watermark, tag, **merge_options)

    (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
