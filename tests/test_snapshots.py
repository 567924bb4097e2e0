import glob
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.plans.ingest import load_reference
from tidemark.sources.snapshots import SnapshotTable

OLD, NOW = datetime(2024, 1, 1), datetime(2024, 2, 1)


def days(spark, *rows):
    return spark.createDataFrame(rows, "id bigint, v bigint, d date")


def data_files(root, pattern="**"):
    return set(glob.glob(f"{root}/data/{pattern}/*.parquet", recursive=True))


def test_nothing_published(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.row_count() == 0 and table.watermark("id") is None
    with pytest.raises(FileNotFoundError):
        table.read()


def test_versions_stay_readable(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert table.publish(spark.range(3)) == 1
    assert table.publish(spark.range(5), watermark="id") == 2
    assert (table.read().count(), table.read(1).count(), table.row_count()) == (5, 3, 5)
    fresh = SnapshotTable(spark, str(tmp_path / "t"))
    assert fresh.watermark("id") == 4 and fresh.read().schema == spark.range(1).schema.__class__(
        [T.StructField("id", T.LongType(), True)]
    )


def test_a_failed_write_publishes_nothing(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.publish(spark.range(3))
    with pytest.raises(Exception):
        table.publish(spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id")))
    other = SnapshotTable(spark, str(tmp_path / "t"))
    assert other.latest() == 1 and other.read().count() == 3
    assert other.publish(spark.range(4)) == 2 and other.read().count() == 4


def test_an_empty_table(spark, tmp_path):
    for part in (None, "d"):
        table = SnapshotTable(spark, str(tmp_path / f"t{part}"), part)
        table.publish(days(spark, (1, 1, date(2024, 1, 1))).limit(0))
        assert table.exists() and table.row_count() == 0
        assert SnapshotTable(spark, table.root, part).read().columns == ["id", "v", "d"]
        assert table.read().count() == 0


def test_merge_rewrites_touched_partitions_only(spark, tmp_path):
    root = str(tmp_path / "t")
    table = SnapshotTable(spark, root, "d")
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    load_reference(table, days(spark, (1, 0, one), (2, 0, two), (3, 0, None)), "create", OLD, watermark="id")
    before = data_files(root)
    load_reference(table, days(spark, (2, 5, two), (4, 5, two), (5, 5, None)), "merge", NOW, "id", watermark="id")
    added = data_files(root) - before
    assert added and all("d=2024-01-02" in f or "d=__HIVE_DEFAULT_PARTITION__" in f for f in added)
    got = sorted((r["id"], r["v"], r["d"], r["dw_create_datetime"]) for r in table.read().collect())
    assert got == sorted([(1, 0, one, OLD), (2, 5, two, OLD), (3, 0, None, OLD), (4, 5, two, NOW), (5, 5, None, NOW)])
    assert table.row_count() == 5 and table.watermark("id") == 5
    second = [e["path"] for e in table.version().entries if e["part"] == "2024-01-02"]
    assert sorted(r["id"] for r in table.read(folders=second).collect()) == [2, 4]
    assert table.read(1).count() == 3


def test_a_growing_series_rewrites_its_last_load_only(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))

    def rows(first, last, value):
        # One file to a load, so that files and loads are the same here.
        return spark.range(first, last, numPartitions=1).select("id", F.lit(value).cast("bigint").alias("v"))

    load_reference(table, rows(0, 100, 0), "create", OLD, watermark="id")
    first = data_files(table.root)
    # Each pull starts at the last key of the one before.
    load_reference(table, rows(99, 110, 1), "merge", NOW, "id", watermark="id")
    load_reference(table, rows(109, 120, 2), "merge", NOW, "id", watermark="id")
    load_reference(table, rows(119, 130, 3), "merge", NOW, "id", watermark="id")
    sizes = sorted(e["row_count"] for e in table.version().entries)
    assert sizes == [10, 10, 10, 100] and table.row_count() == 130
    assert table.watermark("id") == 129
    # The first load was written once more, for the one key it shares with the second.
    reread = SnapshotTable(spark, table.root)
    assert {r["v"]: r["count"] for r in reread.read().groupBy("v").count().collect()} == {0: 99, 1: 10, 2: 10, 3: 11}
    assert first and reread.read(1).filter("v = 0").count() == 100
    # Folders that end before the source begins are not even looked at.
    version = table.version()
    assert len(table._within_reach(version, ["id"], 119)) == 2
    assert len(table._within_reach(version, ["v"], 4)) == 4
    # Nothing shared: nothing rewritten. All shared: all rewritten.
    assert table.touched_by(rows(500, 510, 4), ["id"]) == []
    assert len(table.touched_by(rows(0, 130, 4), ["id"])) == 4
    assert len(table.touched_by(rows(125, 510, 4), ["id"], broadcast_bytes=0)) == 1
    assert table.compact(50, watermark="id") == 5
    assert sorted(e["row_count"] for e in table.version().entries) == [30, 100]
    assert table.read().count() == 130 and table.watermark("id") == 129
    assert table.compact(50) is None


@pytest.mark.parametrize("watermark", [None, "id"])
def test_many_merges_equal_one_table_in_memory(spark, tmp_path, watermark):
    """Random batches, late keys and missing keys among them."""
    import random

    rng, table, want = random.Random(11), SnapshotTable(spark, str(tmp_path / "t")), []
    day = date(2024, 1, 1)
    for step in range(6):
        keys = rng.sample(range(step * 10 - 15 if step else 0, step * 10 + 15), 8)
        batch = [(k, step, day) for k in keys] + [(None, step, day)] * rng.randrange(3)
        load_reference(table, days(spark, *batch), "merge" if step else "create", NOW, "id", watermark=watermark)
        fresh = {k: v for k, v, _ in batch if k is not None}
        held = {k for k, _ in want}
        want = [(k, fresh.get(k, v) if k is not None else v) for k, v in want]
        want += [(k, v) for k, v, _ in batch if k is None or k not in held]
        got = [(r["id"], r["v"]) for r in SnapshotTable(spark, table.root).read().collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert table.row_count() == len(want)


def test_rows_without_a_key_stay_where_they_are(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    day = date(2024, 1, 1)
    load_reference(table, days(spark, (1, 0, day), (None, 0, day)), "create", OLD)
    load_reference(table, days(spark, (None, 1, day), (2, 1, day)), "merge", NOW, "id")
    load_reference(table, days(spark, (2, 2, day), (None, 2, day)), "merge", NOW, "id")
    got = sorted(((r["id"] or 0), r["v"]) for r in table.read().collect())
    assert got == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 2)]


def test_partition_type_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="date or a whole number"):
        SnapshotTable(spark, str(tmp_path / "t"), "s").publish(spark.sql("SELECT 'a/b' AS s, 1 AS v"))


def test_watermark_of_a_column_that_was_not_noted(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    df = spark.range(5).select("id", (F.col("id") * 2).alias("v"))
    table.publish(df, watermark="id")
    assert table.watermark("v") == 8 and table.watermark("id") == 4


def test_timestamp_watermark_keeps_its_micros(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    at = datetime(2024, 1, 1, 2, 3, 4, 567891)
    table.publish(spark.createDataFrame([(at,)], "t timestamp_ntz"), watermark="t")
    assert SnapshotTable(spark, table.root).watermark("t") == at


def test_a_large_partition_is_written_as_several_files(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        table = SnapshotTable(spark, str(tmp_path / "t"), "p")
        wide = spark.range(60_000, numPartitions=4).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).cast("int").alias("p"), F.md5(F.col("id").cast("string")).alias("s")
        )
        table.publish(wide)
    finally:
        spark.conf.unset(key)
    hot = glob.glob(f"{table.root}/data/*/p=1/*.parquet")
    assert len(hot) > 1 and table.row_count() == 60_000
    assert os.path.basename(table.root) == "t"


def test_a_merge_leaves_all_files_without_its_keys_in_place(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows = spark.range(0, 1000, numPartitions=10).select("id", F.lit(0).cast("bigint").alias("v"))
    load_reference(table, rows, "create", OLD, watermark="id")
    before = data_files(table.root)
    load_reference(table, spark.sql("SELECT 250L AS id, 7L AS v"), "merge", NOW, "id", watermark="id")
    fresh = SnapshotTable(spark, table.root)
    paths = fresh.version().folders
    kept = {f for f in before if any(f.endswith(p) for p in paths)}
    assert len(kept) == 9 and len(paths) == 10
    assert sorted(e["row_count"] for e in fresh.version().entries) == [100] * 10
    assert fresh.row_count() == fresh.read().count() == 1000 and fresh.watermark("id") == 999
    assert [(r["id"], r["v"]) for r in fresh.read().filter("v <> 0").collect()] == [(250, 7)]
    # The file that was written anew, and one that stayed, are both found again.
    load_reference(fresh, spark.sql("SELECT * FROM VALUES (250L, 8L), (990L, 8L), (5000L, 8L) AS t(id, v)"), "merge", NOW, "id", watermark="id")
    assert len([f for f in before if any(f.endswith(p) for p in fresh.version().folders)]) == 8
    assert sorted((r["id"], r["v"]) for r in fresh.read().filter("v <> 0").collect()) == [(250, 8), (990, 8), (5000, 8)]
    assert fresh.read(1).filter("v = 0").count() == 1000 and fresh.row_count() == 1001
    fresh.compact(1000, watermark="id")
    assert len(fresh.version().folders) == 1 and fresh.read().count() == 1001 and fresh.watermark("id") == 5000


def test_a_key_moves_to_another_partition(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "d")
    one, two, three = (date(2024, 1, n) for n in (1, 2, 3))
    load_reference(table, days(spark, (1, 0, one), (2, 0, one), (3, 0, two), (None, 0, two), (4, 0, None)), "create", OLD, watermark="id")
    load_reference(table, days(spark, (1, 5, two), (4, 5, three), (5, 5, None), (3, 5, None)), "merge", NOW, "id", watermark="id")
    got = sorted(((r["id"] or 0, r["v"], str(r["d"])) for r in SnapshotTable(spark, table.root, "d").read().collect()))
    assert got == [(0, 0, str(two)), (1, 5, str(two)), (2, 0, str(one)), (3, 5, "None"), (4, 5, str(three)), (5, 5, "None")]
    assert table.row_count() == 6
    parts = {e["part"] for e in table.version().entries}
    assert parts == {str(one), str(two), str(three), None}
    assert table.compact(10) is None
    load_reference(table, days(spark, (6, 9, two), (7, 9, two)), "merge", NOW, "id", watermark="id")
    assert len(table.version().folders) == 5
    assert table.compact(10, watermark="id") and table.read().count() == 8 and table.watermark("id") == 7
    assert len(table.version().folders) == 4


@pytest.mark.parametrize("partitioned_by", [None, "p"])
def test_random_merges_that_move_keys(spark, tmp_path, partitioned_by):
    import random

    rng, table, want = random.Random(5), SnapshotTable(spark, str(tmp_path / "t"), partitioned_by), {}
    for step in range(5):
        batch = {k: (step, rng.randrange(4)) for k in rng.sample(range(40), 12)}
        df = spark.createDataFrame([(k, *v) for k, v in batch.items()], "id bigint, v bigint, p int")
        load_reference(table, df, "merge" if step else "create", NOW, "id")
        want.update(batch)
        got = {r["id"]: (r["v"], r["p"]) for r in SnapshotTable(spark, table.root, partitioned_by).read().collect()}
        assert got == want and table.row_count() == len(want) == table.read().count()
