"""Mix sources to target weights by cutting each at its budget in hash-random order.

A document's key is a digest of a seed and its id; the order of a source is key, then id,
then size. The keys are cut into ranges, the words of each range are summed, running sums
over the ranges find the one in which a source's budget ends, and only that range is sorted
by row. What comes out is one row per source: whole epochs and the place of the cut. No
task holds more of a hot source than one range.

Nulls: a null text has size 0, a null source is a source of its own and comes last, a null
id is the id ''. Rows with the same key, id and size stand at one place of the order and
share what the cut leaves them in whole words (at most one word each is lost). An empty
table gives an empty plan. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.sizes import broadcast_if_small
from tidemark.llm import text as T

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
ROWS_PER_RANGE = 20_000
SEED = "mix-1"


def order_key(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``(doc_id, source, size, key)``, narrow rows."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), T.word_count(F.col(text)).alias("size"),
        order_key(doc_id).alias("key"),
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size, target)``.

    Sources at their limit are those with the smallest limit per weight: sorted by it, source
    i is limited when its limit is at most the level that the rest would reach without it.
    The windows run over one row per source.
    """
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighed = per_source.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), nth).cast("bigint"))
    limit = most * F.col("source_size")
    by_ratio = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = weighed.select(
        "*",
        limit.alias("limit"),
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum(limit).over(before), F.lit(0)).alias("limits_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weights_before"),
    )
    left, share = F.col("total") - F.col("limits_before"), F.col("weights") - F.col("weights_before")
    # limit / weight <= left / share, in whole numbers.
    sums = sums.withColumn("limited", F.col("limit") * share <= left * F.col("weight"))
    free = ~F.col("limited")
    level = F.coalesce(
        (F.max("total").over(everything) - F.coalesce(F.sum(F.when(~free, F.col("limit"))).over(everything), F.lit(0))).cast("double")
        / F.sum(F.when(free, F.col("weight"))).over(everything),
        F.lit(0.0),
    )
    return sums.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(free, F.col("level") * F.col("weight")).otherwise(F.col("limit").cast("double")).alias("target"),
    )


def plan(rows: DataFrame, goal: DataFrame | None = None, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(source, source_size, target, epochs, cut)``; ``cut`` is ``(key, doc_id, size, each)``.

    Every row is taken ``epochs`` times whole; rows before the cut once more, rows at the
    cut ``each`` words more.
    """
    goal = targets(rows) if goal is None else goal
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    # At most 2^28 ranges, numbered by the first 7 digits of the key.
    ranges = max(1, rows.count() // rows_per_range)
    digits = F.conv(F.substring("key", 1, 7), 16, 10).cast("bigint")
    ranged = rows.withColumn("range", F.floor(digits * min(ranges, 1 << 28) / (1 << 28)).cast("bigint"))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("size"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0))).withColumnRenamed("source", "_source")
    small_goal, _ = broadcast_if_small(goal)
    cut_range = (
        sums.join(small_goal, F.col("_source").eqNullSafe(F.col("source")))
        .filter("before <= rest AND rest < before + size")
        .select("_source", F.col("range").alias("_range"), F.col("rest") - F.col("before"))
        .toDF("_source", "_range", "rest")
    )
    cut_range, _ = broadcast_if_small(cut_range)
    places = (
        ranged.join(cut_range, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")))
        .groupBy("_source", "rest", "key", "doc_id", "size")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    in_order = Window.partitionBy("_source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(in_order), F.lit(0))
    cuts = (
        places.withColumn("used", used)
        .filter((F.col("used") <= F.col("rest")) & (F.col("rest") < F.col("used") + F.col("size") * F.col("copies")))
        .select(
            "_source",
            F.struct("key", "doc_id", "size", F.floor((F.col("rest") - F.col("used")) / F.col("copies")).cast("bigint").alias("each")).alias("cut"),
        )
    )
    return small_goal.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "epochs", "cut"
    )


def _more(key: Column, doc_id: Column, size: Column) -> Column:
    """Words taken on top of the whole epochs; the cut's columns are beside the row."""
    place = F.struct(key.alias("key"), doc_id.alias("doc_id"), size.alias("size"))
    cut = F.struct(F.col("_cut.key").alias("key"), F.col("_cut.doc_id").alias("doc_id"), F.col("_cut.size").alias("size"))
    more = F.when(place < cut, size).when(place.eqNullSafe(cut), F.col("_cut.each")).otherwise(0)
    return F.when(F.col("_cut").isNotNull(), more).otherwise(0).cast("bigint")


def _beside(rows: DataFrame, chosen: DataFrame, source: str) -> DataFrame:
    chosen = chosen.select(*[F.col(c).alias(f"_{c}") for c in chosen.columns])
    chosen, _ = broadcast_if_small(chosen)
    return rows.join(chosen, F.col(source).eqNullSafe(F.col("_source")))


def taken(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """What the mix takes of every row of :func:`sized`."""
    joined = _beside(rows, chosen, "source")
    size = F.col("size")
    return joined.select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_epochs") * size + _more(F.col("key"), F.col("doc_id"), size)).alias("taken"),
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word, with its own white space."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    leading = text.rlike(r"^[\x20\x09-\x0D]").cast("int")
    return F.array_join(F.slice(pieces, F.lit(1), (n + leading).cast("int")), "")


def mixed(docs: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, the one at the cut
    up to the cut. Texts are not shuffled."""
    inner = docs.select(
        F.struct("*").alias("_row"), F.col(doc_id).alias("_id"), F.col(source).alias("_src"), T.whole(text).alias("_text"),
        T.word_count(F.col(text)).alias("_size"), order_key(doc_id).alias("_key"),
    )
    joined = _beside(inner, chosen, "_src").withColumn("_more", _more(F.col("_key"), F.col("_id"), F.col("_size")))
    whole_copies = F.array_repeat(F.lit(-1).cast("bigint"), F.col("_epochs").cast("int"))
    part = F.when(F.col("_more") == F.col("_size"), F.lit(-1).cast("bigint")).otherwise(F.col("_more"))
    at_cut = F.when(F.col("_more") > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))
    copies = joined.select("_row", "_text", F.explode(F.concat(whole_copies, at_cut)).alias("_n"))
    own = F.col("_row").getField(text)
    return copies.select(
        *[
            (F.when(F.col("_n") < 0, own).otherwise(first_words(F.col("_text"), F.col("_n"))) if c == text
             else F.col("_row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )
