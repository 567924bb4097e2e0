"""Remove multi-line passages that occur elsewhere, by content-defined chunks of lines.

A rolling hash over the hashes of the last WINDOW lines ends a chunk where it is 0 modulo
AVERAGE, so the same passage is cut alike wherever it stands and cuts fall in step again
WINDOW lines after a difference. A short passage seldom holds a whole chunk, so every pair of
neighbouring lines that hold a word is a piece too, with the lines without a word between
them: a passage of two lines or more is covered by its pairs. Pieces are chunks of two or more
lines that hold a word, and pairs. They are counted over all documents by SHA-256 alone; the
texts of repeated digests are then grouped by their bytes. Of equal pieces the first (lowest
document id, then place) is no repeat, the lines of all later ones go; a later one that
overlaps the first loses only what lies past it. The first place of a line is never in a
later piece, so no line is lost from the corpus.

Nulls: a null text is an empty one. Rows with one document id count as one document: a piece
at the same place of both is one occurrence. A digest that stood for two different texts
would be left alone. Rows with a null id keep their lines and count as one document. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.sizes import broadcast_if_small
from tidemark.llm import text as T

#: The rolling hash: window in lines, base, and modulus; chunks have AVERAGE lines or so.
WINDOW, BASE, MODULUS, AVERAGE = 2, 1_000_003, (1 << 31) - 1, 4


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("bigint")


def chunks(text: Column) -> Column:
    """``array<struct<start, n>>``: the chunks of a text in order, by first line and number of lines."""

    def of_hashes(lines: Column, hashes: Column) -> Column:
        def rolling(i: Column) -> Column:
            value = F.lit(0).cast("bigint")
            for back in range(WINDOW - 1, -1, -1):
                value = (value * BASE + F.coalesce(F.get(hashes, i - back), F.lit(0))) % MODULUS
            return value

        last = F.size(lines) - 1
        ends = F.filter(F.sequence(F.lit(0), last), lambda i: (rolling(i) % AVERAGE == 0) | (i == last))
        return T.let(
            ends,
            lambda e: F.transform(
                e,
                lambda end, j: T.let(
                    F.when(j == 0, F.lit(0)).otherwise(F.get(e, j - 1) + 1),
                    lambda start: F.struct(start.alias("start"), (end - start + 1).alias("n")),
                ),
            ),
        )

    return T.let(F.split(text, "\n"), lambda lines: T.let(F.transform(lines, line_hash), lambda h: of_hashes(lines, h)))


def pieces(text: Column) -> Column:
    """``array<struct<start, stop, body>>``: chunks and pairs of lines of a text, by line numbers from 0."""

    def of_lines(lines: Column) -> Column:
        span = lambda start, stop: F.struct(start.alias("start"), stop.alias("stop"))
        worded = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(T.WORD_RUN))
        pairs = T.let(
            worded, lambda w: F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda i, j: span(i, F.get(w, j + 1)))
        )
        long = F.transform(F.filter(chunks(text), lambda c: c["n"] >= 2), lambda c: span(c["start"], c["start"] + c["n"] - 1))
        return F.transform(
            F.array_union(long, pairs),
            lambda x: F.struct(
                x["start"].alias("start"), x["stop"].alias("stop"),
                F.array_join(F.slice(lines, x["start"] + 1, x["stop"] - x["start"] + 1), "\n").alias("body"),
            ),
        )

    return T.let(F.split(text, "\n"), of_lines)


def spread(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, version, start, stop, body)``, one row per piece; ``version`` tells texts of one id apart."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(T.whole(text)).alias("version"), F.explode(pieces(T.whole(text))).alias("p"))
    return rows.select("doc_id", "version", "p.start", "p.stop", "p.body")


def repeated(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, version, removed)``: numbers of the lines that go, for documents that lose any."""
    digest = F.unhex(F.sha2("body", 256))
    parts = spread(docs, doc_id, text).filter(F.col("body").rlike(T.WORD_RUN) & F.col("doc_id").isNotNull()).withColumn("digest", digest)
    slim = T.written(parts.drop("body"), spark, "chunk-digests")
    place = F.struct("doc_id", "start")
    seen = slim.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "start", "stop", "version")).alias("first"), F.max(place).alias("last")
    )
    again = F.struct("first.doc_id", "first.start") != F.col("last")
    twice = T.written(seen.filter((F.col("n") > 1) & again).select("digest", "first"), spark, "chunk-repeats")
    # Byte comparison: how many texts stand behind each repeated digest. Only the bodies of repeated
    # digests move, and once; copies meet in the map tasks' partial counts first.
    wanted, small = broadcast_if_small(twice.select("digest"))
    bodies = parts.select("digest", "body").join(wanted, "digest", "left_semi") if small else bodies_of(docs, slim, wanted, doc_id, text)
    texts = bodies.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("copies"))
    equal = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts = 1").select("digest")
    known = T.written(twice.join(equal, "digest", "left_semi"), spark, "chunk-equal")
    later = slim.join(known, "digest").filter(place != F.struct("first.doc_id", "first.start"))
    overlaps = (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.version") == F.col("version")) & (F.col("first.stop") >= F.col("start"))
    begin = F.when(overlaps, F.col("first.stop") + 1).otherwise(F.col("start"))
    lines = later.select("doc_id", "version", F.explode(F.sequence(begin, F.col("stop"))).alias("line"))
    return lines.groupBy("doc_id", "version").agg(F.collect_set("line").alias("removed"))


def bodies_of(docs: DataFrame, slim: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(digest, body)`` of the pieces with these digests: their places are brought to the documents,
    so other bodies never leave them. A document's places are one list, as long as its lines."""
    place = F.struct("start", "stop", "digest")
    places = slim.join(wanted, "digest", "left_semi").groupBy("doc_id", "version").agg(F.collect_list(place).alias("_at"))
    places = places.toDF("_place_id", "_place_version", "_at")
    mine = (F.col(doc_id) == F.col("_place_id")) & (F.xxhash64(T.whole(text)) == F.col("_place_version"))
    rows = docs.join(places, mine).select(F.split(T.whole(text), "\n").alias("_lines"), F.explode("_at").alias("_p"))
    body = F.array_join(F.slice("_lines", F.col("_p.start") + 1, F.col("_p.stop") - F.col("_p.start") + 1), "\n")
    return rows.select(F.col("_p.digest").alias("digest"), body.alias("body"))


def cleaned(docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``(n_chunks, removed_chunks, removed_lines, clean)`` in a struct ``_clean``;
    a chunk counts as removed when all its lines are."""
    gone, _ = broadcast_if_small(gone.toDF("_gone_id", "_gone_version", "_gone"))
    mine = (F.col(doc_id) == F.col("_gone_id")) & (F.xxhash64(T.whole(text)) == F.col("_gone_version"))
    joined = docs.join(gone, mine, "left")
    removed = F.coalesce("_gone", F.array().cast("array<int>"))

    def summary(lines: Column, n: Column) -> Column:
        chunk_of = F.flatten(F.transform(n, lambda size, j: F.array_repeat(j, size)))
        stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)

        def of_rest(rest: Column) -> Column:
            left = T.let(chunk_of, lambda c: F.size(F.array_distinct(F.transform(rest, lambda i: F.get(c, i)))))
            return F.struct(
                F.size(n).cast("bigint").alias("n_chunks"),
                (F.size(n) - left).cast("bigint").alias("removed_chunks"),
                (F.size(lines) - F.size(rest)).cast("bigint").alias("removed_lines"),
                F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n").alias("clean"),
            )

        return T.let(stays, of_rest)

    sizes = F.transform(chunks(T.whole(text)), lambda c: c["n"])
    clean = T.let(F.split(T.whole(text), "\n"), lambda lines: T.let(sizes, lambda n: summary(lines, n)))
    return joined.withColumn("_clean", clean).drop("_gone_id", "_gone_version", "_gone")


def line_dedup(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the cleaned texts."""
    gone = T.written(repeated(docs, spark, doc_id, text), spark, "chunk-removals")
    out = cleaned(docs, gone, doc_id, text)
    return out.select(*[F.col("_clean.clean").alias(c) if c == text else F.col(c) for c in docs.columns])
