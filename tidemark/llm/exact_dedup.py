"""Exact deduplication over an extendible-hash index on shared files.

Every row becomes an index entry: 64-bit key of its normalised text (A-Z lower-cased), its
SHA-256 and its id. Entries of equal texts are merged before they move, so a text with any
share of the rows is one record per task. The directory starts with one bucket and doubles
while a bucket holds more records than it may: a full bucket of local depth d splits into the
two of depth d + 1; records of one and the same key cannot be split and chain. The records
are written to the shared folder by owner, each owner having a range of the directory. Records
that stand for several rows, or share a key, are then compared byte by byte: their texts are
merged into LANES records each at most, so that a hot text is no hot key, and go to the owners of
their range of (bucket, key). An owner compares the bytes of its texts and chains different texts
with one key.

Nulls: a null text is an empty one; a null id sorts below all others. Of rows that are equal
in text and id one stays. An empty table gives an empty result. Other columns stay as they
are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.sizes import broadcast_if_small
from tidemark.llm import text as T

BUCKET_RECORDS = 50_000
#: The directory has 2^16 entries at most, so it may be broadcast; fuller buckets are cut by key.
MAX_DEPTH = 16
#: Copies of one text reach their owner as at most this many records.
LANES = 8


def normalised(text: str) -> Column:
    return T.lower_ascii(T.whole(text))


def key_of(norm: str) -> Column:
    return F.xxhash64(norm)


def entries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, digest, doc_id)``, one narrow row per document."""
    norm = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("_norm"))
    return norm.select(key_of("_norm").alias("key"), F.sha2("_norm", 256).alias("digest"), "doc_id")


def records(index: DataFrame) -> DataFrame:
    """``(key, digest, keep_id, group_size)``, one row per text."""
    return index.groupBy("key", "digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def _prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of the key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def directory(texts: DataFrame, capacity: int = BUCKET_RECORDS, max_depth: int = MAX_DEPTH) -> tuple[int, list[tuple[int, int]]]:
    """``(global depth, buckets)``: entry i of the directory names the bucket, as (local depth,
    prefix), of all keys that begin with the bits of i. A bucket holds at most ``capacity``
    records where bits are left to split by. The driver sees at most 2^max_depth counts."""
    finest = texts.groupBy(_prefix(F.col("key"), max_depth).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    levels: list[dict[int, int]] = [{r["p"]: r["n"] for r in finest}]
    for _ in range(max_depth):
        coarser: dict[int, int] = {}
        for p, n in levels[0].items():
            coarser[p >> 1] = coarser.get(p >> 1, 0) + n
        levels.insert(0, coarser)
    depth, entries_ = 0, [(0, 0)]
    while depth < max_depth:
        full = {b for b in entries_ if b[0] == depth and levels[depth].get(b[1], 0) > capacity}
        if not full:
            break
        # Doubling: every entry twice, and the full buckets' halves apart.
        entries_ = [(d + 1, 2 * p + half) if (d, p) in full else (d, p) for d, p in entries_ for half in (0, 1)]
        depth += 1
    return depth, entries_


def with_bucket(texts: DataFrame, spark: SparkSession, depth: int, buckets: list[tuple[int, int]]) -> DataFrame:
    """``texts`` with the number of the bucket that the directory names for their key."""
    number = {b: i for i, b in enumerate(dict.fromkeys(buckets))}
    table = spark.createDataFrame([(i, number[b]) for i, b in enumerate(buckets)], "_entry bigint, bucket int")
    return texts.join(F.broadcast(table), _prefix(F.col("key"), depth) == F.col("_entry")).drop("_entry")


def build_index(docs: DataFrame, spark: SparkSession, capacity: int = BUCKET_RECORDS, **columns: str) -> tuple[DataFrame, DataFrame]:
    """``(entries, records)`` as tables on shared files; records carry their bucket."""
    index = T.written(entries(docs, **columns), spark, "dedup-entries")
    texts = T.written(records(index), spark, "dedup-texts")
    owned = with_bucket(texts, spark, *directory(texts, capacity))
    owned = owned.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return index, T.written(owned, spark, "dedup-index")


def to_owners(texts: DataFrame) -> DataFrame:
    """Texts of ``(bucket, key, _norm, keep_id, n)`` with the owners of their range, merged by their bytes."""
    own = texts.repartitionByRange("bucket", "key")
    return own.groupBy("bucket", "key", "_norm").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def compared(docs: DataFrame, owned: DataFrame, spark: SparkSession, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Records of repeated texts after the byte comparison. Where the repeated keys can be broadcast,
    only texts with such a key move; copies of a text meet in the map tasks' partial groups first.

    ``(key, digest, chain, keep_id, group_size)``; ``chain`` numbers the texts of a key.
    """
    chained = owned.groupBy("bucket", "key").agg(F.sum("group_size").alias("n")).filter("n > 1").select("bucket", "key")
    chained, _ = broadcast_if_small(T.written(chained, spark, "dedup-keys"))
    norm = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("_norm")).withColumn("key", key_of("_norm"))
    suspects = norm.join(chained, "key").withColumn("_lane", F.pmod(F.xxhash64("doc_id"), F.lit(LANES)))
    merged = suspects.groupBy("bucket", "key", "_norm", "_lane").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    equal = to_owners(T.written(merged.drop("_lane"), spark, "dedup-suspects"))
    # A chain holds different texts with one 64-bit key: hardly ever more than one.
    chain = Window.partitionBy("bucket", "key").orderBy("digest", "keep_id")
    return equal.select("bucket", "key", F.sha2("_norm", 256).alias("digest"), "keep_id", "group_size").select(
        "key", "digest", "keep_id", "group_size", F.row_number().over(chain).alias("chain")
    )


def resolve(index: DataFrame, same: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per entry."""
    groups = same.select(
        F.col("key").alias("_key"), F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep"), F.col("group_size").alias("_n")
    )
    joined = index.join(groups, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left")
    grouped = F.col("_n").isNotNull()
    found = joined.select(
        "doc_id",
        F.when(grouped, F.col("_keep")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("digest").alias("text_sha256"),
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_dedup(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text", capacity: int = BUCKET_RECORDS) -> DataFrame:
    index, owned = build_index(docs, spark, capacity, doc_id=doc_id, text=text)
    same = T.written(compared(docs, owned, spark, text, doc_id), spark, "dedup-compared")
    found = resolve(index, same)
    # Rows equal in text and id: the id alone cannot tell them apart, so one of them is kept.
    return _one_of_ties(found)


def _one_of_ties(found: DataFrame) -> DataFrame:
    ties = (
        found.filter("kept").groupBy("text_sha256", "keep_id").agg(F.count(F.lit(1)).alias("_ties")).filter("_ties > 1")
    )
    if ties.isEmpty():
        return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    # Repeated rows leave as one kept row and a count of dropped ones.
    rows = found.groupBy("doc_id", "keep_id", "group_size", "kept", "text_sha256").agg(F.count(F.lit(1)).alias("_n"))
    dropped = rows.withColumn("_d", F.when(F.col("kept"), F.col("_n") - 1).otherwise(F.col("_n")))
    once = rows.filter("kept").drop("_n")
    again = dropped.filter("_d > 0").withColumn("_r", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_d"))))
    again = again.withColumn("kept", F.lit(False)).select(*once.columns)
    return once.unionByName(again).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def dropped_keys(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, digest, keep_id)`` of the texts that occur more than once."""
    _, owned = build_index(docs, spark, doc_id=doc_id, text=text)
    return compared(docs, owned, spark, text, doc_id).filter("group_size > 1").select("key", "digest", "keep_id")


def keep_one(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    groups = T.written(dropped_keys(docs, spark, doc_id, text), spark, "dedup-groups").toDF("_key", "_digest", "_keep")
    groups, _ = broadcast_if_small(groups)
    norm = normalised(text)
    inner = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_id"), norm.alias("_norm"))
    inner = inner.select("_row", "_id", key_of("_norm").alias("key"), F.sha2("_norm", 256).alias("digest"))
    joined = inner.join(groups, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left")
    stays = joined.filter(F.col("_digest").isNull() | F.col("_id").eqNullSafe(F.col("_keep")))
    ties = (
        stays.filter(F.col("_digest").isNotNull()).groupBy("_digest", "_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    if not ties.isEmpty():
        alone, several = stays.filter("_digest IS NULL"), stays.filter("_digest IS NOT NULL")
        several = several.groupBy("_digest").agg(F.first("_row").alias("_row"))
        stays = alone.select("_row").unionByName(several.select("_row"))
    return stays.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
