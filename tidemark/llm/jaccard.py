"""Documents with nearly equal sets of word n-grams, by vertical partitioning.

A document is its set of distinct 5-word shingles (hashed); two link when the Jaccard
similarity is 0.8 or more. All rows with one set are one node from the start, whatever their
ids; links are between nodes, and only the result goes back to document ids.

Documents that can link at all. A document of n elements may lack at most n - ceil(0.8 n) of
them in a partner, so one with more elements that occur nowhere else has none. This is tested
twice: on the elements in the first HEAD_SHARE of the order, for all documents, and later on
all elements of the documents that are still open, where an element counts only if another
component has it. The second count, summed over the fragments, also bounds a partner's size.

Candidates. Two linked sets share an element among their first n - ceil(0.8 n) + 1 in the
global order of the n-grams, so only these prefixes are matched.

* Rounds of hubs: the hub of an n-gram is the document whose head others share most. Each document
  meets one hub of another component, that with which it shares most, so a round is no larger
  than the documents. Links merge components; rounds go on while a quarter of them link.
* N-grams that are still in several components and have few documents (FEW): all pairs of them
  across components are counted. A pair goes on when the n-grams it shares, with all crowded ones
  of a document granted, can make up for those it must share.
* Crowded n-grams, as of a passage that many documents share. A linked pair that shares
  nothing else in its prefixes must fill the shorter prefix with them: of the document whose
  prefix ends first at most n - overlap elements are not shared, and the other has few
  elements below that end. The smallest number of elements that any document of a size has
  below each of GRID points of the order rules most documents out at once; only the rest
  are queries, in blocks of inverted lists, against the documents with crowded n-grams. Here the
  overlaps are counted in the task, fragment by fragment over the whole sets, so a near miss
  never leaves it; of all links between two components one row per batch does, as one merges them.

All bounds are exact, so no link is lost and no n-gram or candidate is dropped.

Verification. The global order is cut into FRAGMENTS ranges. Each document's n-grams lie in
one row per fragment, the overlap of a pair is counted in each fragment apart and summed per
pair. Working tables are removed when the next one is written.

Nulls: a null text is an empty one; an empty set links with nothing. A document of one to
four words has its whole word sequence as the only n-gram. Rows with one id are told apart by
their texts. A row without an id takes part as any other; a component's id is its smallest id, null
if it has none. Other columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.sizes import BROADCAST_BYTES, broadcast_if_small
from tidemark.llm import bytewords as B
from tidemark.llm import text as T

WORDS, PERCENT = 5, 80
FRAGMENTS = 8
#: All elements in this first share of the order are matched, beyond the prefix too.
HEAD_SHARE = 0.3
HEAD_END = int(HEAD_SHARE * (1 << 64)) - (1 << 63)
#: Sizes are rounded to powers of this where only the reach of partners is asked for.
SIZE_STEP = 1.02
#: Documents of an n-gram, beyond which it is crowded.
FEW_PAIRS = 32
#: Points of the order, every 1/128 of its range from the start: prefixes end about 0.2.
GRID = 64
#: Queries on crowded n-grams are broadcast in blocks of this size at most.
BLOCK_BYTES = 64 * 1024 * 1024
_MULTIPLIERS = B.mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every text, as signed 64-bit values in hash order."""
    for first, last, at, h in B.hashed_words(texts):
        n = last - first
        grams = np.zeros(max(0, len(h) - WORDS + 1), dtype=np.uint64)
        for k in range(WORDS):
            grams += h[k : k + len(grams)] * _MULTIPLIERS[k]
        own = at[: len(grams)] == at[WORDS - 1 :][: len(grams)]
        doc, gram = at[: len(grams)][own], B.mix(grams[own])
        counts = np.bincount(at, minlength=n)
        short = np.flatnonzero((counts > 0) & (counts < WORDS))
        if len(short):
            begin = np.searchsorted(at, short)
            sums = [np.add.reduce(h[b : b + c] * _MULTIPLIERS[:c]) for b, c in zip(begin, counts[short])]
            whole = B.mix(np.array(sums, dtype=np.uint64) + counts[short].astype(np.uint64))
            doc, gram = np.concatenate([doc, short]), np.concatenate([gram, whole])
        gram = gram.view(np.int64)
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        doc, gram = doc[new], gram[new]
        yield from np.split(gram, np.searchsorted(doc, np.arange(1, n)))


def prefix_length(n: int) -> int:
    """n - ceil(PERCENT / 100 n) + 1."""
    return n - -(-PERCENT * n // 100) + 1


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``head`` has the prefix and all elements below HEAD_END, ``below`` counts the latter;
    ``ranks`` counts the prefix elements below each point of the grid."""
    grid = np.array([(i << 57) - (1 << 63) for i in range(GRID)], dtype=np.int64)
    for batch in batches:
        sizes, nodes, heads, below, ranks = [], [], [], [], []
        for s in shingle_sets(batch.column(1).to_pylist()):
            first = s[: prefix_length(len(s))] if len(s) else s
            sizes.append(len(s))
            nodes.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True))
            below.append(int(np.searchsorted(s, HEAD_END)))
            heads.append(s[: max(len(first), below[-1])])
            ranks.append(np.searchsorted(first, grid))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(below, pa.int64()), _lists(heads), _lists(ranks),
            ],
            names=["doc_id", "version", "n", "node", "below", "head", "ranks"],
        )


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, text`` to ``doc, parts``: the n-grams of each fragment of the global order."""
    cuts = np.array([(i << 64) // FRAGMENTS - (1 << 63) for i in range(1, FRAGMENTS)], dtype=np.int64)
    for batch in batches:
        parts = [part for s in shingle_sets(batch.column(1).to_pylist()) for part in np.split(s, np.searchsorted(s, cuts))]
        offsets = pa.array(np.arange(batch.num_rows + 1) * FRAGMENTS, pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, _lists(parts))], names=["doc", "parts"])


def _prefix(n: Column) -> Column:
    return n - F.ceil(n * PERCENT / F.lit(100)).cast("bigint") + 1


def _spare(n: Column, other: Column) -> Column:
    """How many elements of a set of n a linked set of the other size may lack."""
    return n - F.ceil((n + other) * PERCENT / F.lit(100 + PERCENT)).cast("bigint")


def _sizes_fit(n: Column, other: Column) -> Column:
    return (n * 100 >= other * PERCENT) & (other * 100 >= n * PERCENT)


def _caps_fit() -> Column:
    """Neither document is larger than the other can link with."""
    return (F.col("a_n") <= F.col("b_cap")) & (F.col("b_n") <= F.col("a_cap"))


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{side}_{c}" if c != "t" else "t") for c in rows.columns])


def hub_pairs(postings: DataFrame, tried: DataFrame | None) -> DataFrame:
    """``(a, b, a_n, b_n)``: every document b with the hub a of another component with which it shares
    most, at least a third of its prefix. ``postings`` has ``(t, doc, n, shared, label)``."""
    hub = postings.groupBy("t").agg(F.max(F.struct("shared", "doc", "n", "label")).alias("h"))
    near = postings.select("t", F.col("doc").alias("b"), F.col("n").alias("b_n"), "label").join(hub, "t")
    near = near.select(F.col("h.doc").alias("a"), "b", F.col("h.n").alias("a_n"), "b_n", (F.col("label") != F.col("h.label")).alias("_apart"))
    near = near.filter(F.col("_apart") & _sizes_fit(F.col("a_n"), F.col("b_n")))
    shared = near.groupBy("a", "b", "a_n", "b_n").agg(F.count(F.lit(1)).alias("k"))
    shared = shared.filter(F.col("k") * 3 >= _prefix(F.col("b_n")))
    if tried is not None:
        shared = shared.join(tried.select("a", "b"), ["a", "b"], "left_anti")
    best = shared.groupBy("b").agg(F.max(F.struct("k", "a", "a_n", "b_n")).alias("x"))
    return best.select("x.a", "b", "x.a_n", "x.b_n")


def light_pairs(rows: DataFrame, crowding: DataFrame) -> DataFrame:
    """``(a, b, a_n, b_n)``: pairs across components that share n-grams which are not crowded,
    as far as their number allows a link. ``crowding`` has the crowded n-grams per document."""
    near = _side(rows, "a").join(_side(rows, "b"), "t")
    near = near.filter(
        (F.col("a_doc") < F.col("b_doc")) & (F.col("a_label") != F.col("b_label")) & _sizes_fit(F.col("a_n"), F.col("b_n")) & _caps_fit()
    )
    shared = near.groupBy(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"), "a_n", "b_n").agg(F.count(F.lit(1)).alias("k"))
    for side in ("a", "b"):
        more = crowding.select(F.col("doc").alias(side), F.col("h").alias(f"{side}_h"))
        shared = shared.join(more, side, "left")
    # The document whose prefix ends first shares all of it but what it may lack.
    enough = [
        F.col("k") + F.coalesce(f"{x}_h", F.lit(0)) >= _prefix(F.col(f"{x}_n")) - _spare(F.col(f"{x}_n"), F.col(f"{y}_n"))
        for x, y in (("a", "b"), ("b", "a"))
    ]
    return shared.filter(enough[0] | enough[1]).select("a", "b", "a_n", "b_n")


def _links(postings: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``doc, label, n, cap, parts`` to ``a, b``: links of the queries with documents of other components,
    one of every two components and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, doc, label, n, cap = postings.value
        for batch in batches:
            merged: dict[tuple[int, int], tuple[int, int]] = {}
            for y, y_label, y_n, y_cap, parts in zip(*[c.to_pylist() for c in batch.columns]):
                fits = (label != y_label) & (n * 100 >= y_n * PERCENT) & (y_n * 100 >= n * PERCENT) & (n <= y_cap) & (y_n <= cap)
                if not fits.any():
                    continue
                overlap = np.zeros(len(doc), dtype=np.int64)
                for (grams, query), part in zip(lists, parts):
                    own = np.array(part, dtype=np.int64)
                    first, last = np.searchsorted(grams, own), np.searchsorted(grams, own, side="right")
                    counts = last - first
                    at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                    overlap += np.bincount(query[at], minlength=len(doc))
                hits = np.flatnonzero(fits & (overlap * (100 + PERCENT) >= (n + y_n) * PERCENT))
                for x_label, x in zip(label[hits].tolist(), doc[hits].tolist()):
                    merged.setdefault((min(x_label, y_label), max(x_label, y_label)), (x, y))
            found = np.array(list(merged.values()), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], names=["a", "b"])

    return run


def crowded_links(crowding: DataFrame, cut: DataFrame, spark: SparkSession) -> DataFrame:
    """``(a, b)``: links across components by crowded n-grams, at least one of every two components
    that have any.

    ``crowding`` has ``(doc, label, n, cap, h, ranks, q)``: the number of crowded n-grams of a
    document, elements below the grid points, last grid point before the end of its prefix.
    Queries meet the documents as inverted lists, in blocks of at most BLOCK_BYTES.
    """
    bucket = F.floor(F.ln(F.col("n").cast("double")) / float(np.log(1.25))).cast("int")
    sized = crowding.withColumn("bucket", bucket)
    fewest = (
        sized.select("bucket", "q", F.posexplode("ranks").alias("at", "r"))
        .filter("at <= q")
        .groupBy(F.col("bucket").alias("_bucket"), F.col("at").alias("_at"))
        .agg(F.min("r").alias("fewest"))
    )
    # What a partner may have below the end of x's prefix: h and what it may lack.
    most = F.col("h") + F.least(F.col("n") * 0.25, F.col("h") * 1.25) + 1
    reach = F.array(*[F.col("bucket") + d for d in (-2, -1, 0, 1, 2)])
    able = (
        sized.select("doc", "q", most.alias("most"), F.explode(reach).alias("_b"))
        .join(F.broadcast(fewest), (F.col("_b") == F.col("_bucket")) & (F.col("q") == F.col("_at")))
        .filter("fewest <= most")
        .select("doc")
        .distinct()
    )
    docs, _ = broadcast_if_small(crowding.select("doc", "label", "n", "cap"))
    rows = cut.join(docs, "doc").select("doc", "label", "n", "cap", "parts")
    able, _ = broadcast_if_small(T.written(able, spark, "crowded-able", measure=True))
    queries = T.written(rows.join(able, "doc", "left_semi"), spark, "crowded-queries")
    size = F.aggregate("parts", F.lit(64).cast("bigint"), lambda b, part: b + 16 * F.size(part))
    blocks = 1 + (queries.agg(F.sum(size)).first()[0] or 0) // BLOCK_BYTES
    found = []
    for i in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("doc"), F.lit(blocks)) == i).toArrow()
        if not part.num_rows:
            continue
        lists, parts = [], part["parts"].combine_chunks()
        for f in range(FRAGMENTS):
            one = pc.list_element(parts, f)
            values, of = (x.to_numpy(zero_copy_only=False) for x in (one.flatten(), pc.list_parent_indices(one)))
            order = np.argsort(values, kind="stable")
            lists.append((values[order], of[order]))
        postings = spark.sparkContext.broadcast((lists, *[part[c].to_numpy() for c in ("doc", "label", "n", "cap")]))
        links = rows.mapInArrow(_links(postings), "a bigint, b bigint")
        found.append(T.written(links, spark, "crowded-links"))
        postings.destroy()
    T.drop(queries)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "a bigint, b bigint")


def linked(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """``(a, b)`` of the pairs that reach the similarity: partial overlaps summed per pair.

    ``pairs`` is a written table. Pairs are broadcast to the fragments of b if they are few; those
    of a are broadcast if they measure at most BLOCK_BYTES, and else shuffled to them.
    """
    near, few = broadcast_if_small(pairs)
    wanted = pairs.select("a").distinct()
    wanted = F.broadcast(wanted) if few else broadcast_if_small(wanted)[0]
    left = fragments.join(wanted, F.col("doc") == F.col("a"), "left_semi").select("doc", F.posexplode("parts").alias("fragment", "grams"))
    left = left.select(F.col("doc").alias("a"), "fragment", F.col("grams").alias("_a"))
    size = left.agg(F.sum(F.size("_a") * 8 + 64)).first()[0] or 0
    right = fragments.withColumnRenamed("doc", "b").join(near, "b").select("a", "b", "a_n", "b_n", F.posexplode("parts").alias("fragment", "_b"))
    parts = right.join(F.broadcast(left) if size <= BLOCK_BYTES else left, ["a", "fragment"])
    overlap = F.sum(F.size(F.array_intersect("_a", "_b"))).alias("o")
    summed = parts.groupBy("b", "a", "a_n", "b_n").agg(overlap)
    return summed.filter(F.col("o") * (100 + PERCENT) >= (F.col("a_n") + F.col("b_n")) * PERCENT).select("a", "b")


def components(links: DataFrame, spark: SparkSession) -> DataFrame:
    """``(doc, label)``: the smallest document of each component, for documents with links.

    Alternates the large-star and small-star steps until every document hangs on one that
    hangs on none; every step is a minimum per document and a join, so a hub of any degree is
    never gathered. Minima per document are no more than the edges: where these can be broadcast,
    so are they.
    """
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi != lo").distinct()
    edges = T.written(edges, spark, "component-edges", measure=True)
    while True:
        # An edge has two ends, so there are at most twice as many minima.
        small_enough = 2 * edges._tidemark_bytes <= BROADCAST_BYTES
        hint = F.broadcast if small_enough else (lambda df: df)
        # Once as a lower end, and as an upper end as often as there are neighbours below.
        ends = edges.select(F.col("hi").alias("u"), F.lit(1).alias("up")).unionByName(edges.select(F.col("lo").alias("u"), F.lit(0).alias("up")))
        per_doc = ends.groupBy("u").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
        if per_doc.filter("ups > 1 OR (ups = 1 AND least = 0)").isEmpty():
            return edges.select(F.col("hi").alias("doc"), F.col("lo").alias("label"))
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(hint(least), "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large if small_enough else large.distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(hint(low), "hi").filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        older, edges = edges, T.written(small.unionByName(low.withColumnRenamed("m", "lo")).distinct(), spark, "component-edges", measure=True)
        T.drop(older)


def able_by_head(found: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` of the documents that may link, by their elements below HEAD_END.

    ``found`` has ``(t, doc)`` of the elements that several sets have in their heads.
    """
    shared = found.filter(F.col("t") < HEAD_END).groupBy(F.col("doc").alias("_doc")).agg(F.count(F.lit(1)).alias("s"))
    joined = places.join(shared, F.col("doc") == F.col("_doc"), "left").withColumn("s", F.coalesce("s", F.lit(0)))
    # How much of its head others have, of 1,000: all of it in the text that a family descends from.
    share = F.floor(F.col("s") * 1000 / F.greatest("below", F.lit(1))).cast("bigint")
    return joined.filter(F.col("below") - F.col("s") < _prefix(F.col("n"))).withColumn("shared", share).drop("_doc", "s")


def able_by_set(cut: DataFrame, open_docs: DataFrame, spark: SparkSession) -> DataFrame:
    """``(doc, cap)``: documents that may link with another component, and the largest
    partner that they may have.

    ``cut`` has the fragments of all ``open_docs`` ``(doc, n, label)``. Elements that other
    components have are counted per fragment and summed per document.
    """
    labels, _ = broadcast_if_small(open_docs.select("doc", "label"))
    rows = cut.join(labels, "doc").select("doc", "label", F.explode(F.flatten("parts")).alias("t"))
    spread = rows.groupBy("t").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("t")
    shared = rows.select("t", "doc").join(spread, "t").groupBy("doc").agg(F.count(F.lit(1)).alias("m"))
    cap = F.floor(F.col("m") * (100 + PERCENT) / F.lit(PERCENT)).cast("bigint") - F.col("n")
    reach = open_docs.join(shared, "doc").select("doc", "n", F.least(cap, F.floor(F.col("n") * 100 / F.lit(PERCENT))).alias("cap"))
    reach = T.written(reach.filter(F.col("cap") * 100 >= F.col("n") * PERCENT), spark, "reach")

    def bucket(n: Column) -> Column:
        return F.floor(F.ln(n.cast("double")) / float(np.log(SIZE_STEP))).cast("int")

    widest = reach.groupBy(bucket(F.col("n")).alias("_b")).agg(F.max("cap").alias("widest"))
    partners = F.explode(F.sequence(bucket(F.ceil(F.col("n") * PERCENT / F.lit(100))), bucket(F.col("cap"))))
    # One row per size step: a few thousand for any input.
    met = reach.select("doc", "n", partners.alias("_b")).join(F.broadcast(widest), "_b").filter("widest >= n")
    return reach.join(met.select("doc").distinct(), "doc", "left_semi").select("doc", "cap")


def unresolved(labelled: DataFrame) -> DataFrame:
    """``(t, few)`` of n-grams whose documents lie in several components."""
    per_gram = labelled.groupBy("t").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"))
    return per_gram.filter("lo != hi").select("t", (F.col("m") <= FEW_PAIRS).alias("few"))


class _Nodes:
    """The nodes of one call: where their texts are, their links so far and their components."""

    def __init__(self, docs: DataFrame, sets: DataFrame, spark: SparkSession):
        self.docs, self.spark = docs, spark
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")).alias("_first")
        several = sets.filter("n > 0").groupBy("node").agg(first, F.count(F.lit(1)).alias("members")).filter("members > 1")
        several = T.written(several.select(F.col("node").alias("doc"), "_first"), spark, "shingle-classes", measure=True)
        known, _ = broadcast_if_small(several)
        own = sets.filter("n > 0").withColumnRenamed("node", "doc").join(known, "doc", "left")
        one = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("version") == F.col("_first.version"))
        self.own = own.filter(F.col("_first").isNull() | one).drop("_first")
        # The same id and text several times: any of the rows will do.
        same = sets.filter("n > 0").groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        self.repeated = not same.isEmpty()
        if self.repeated:
            self.own = self.own.dropDuplicates(["doc"])
        self.tried: DataFrame | None = None
        self.labels: DataFrame | None = None

    def fragments(self, nodes: DataFrame) -> DataFrame:
        """``(doc, parts)`` of these nodes."""
        wanted = self.own.select("doc", F.col("doc_id").alias("_id"), F.col("version").alias("_version")).join(nodes, "doc", "left_semi")
        wanted, _ = broadcast_if_small(T.written(wanted, self.spark, "shingle-sources", measure=True))
        mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
        cut = self.docs.join(wanted, mine).select("doc", "text").mapInArrow(_fragments, "doc bigint, parts array<array<bigint>>")
        return T.written(cut.dropDuplicates(["doc"]) if self.repeated else cut, self.spark, "shingle-fragments")

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of ``doc`` as ``label``."""
        if self.labels is None:
            return rows.withColumn("label", F.col("doc"))
        labels, _ = broadcast_if_small(self.labels)
        return rows.drop("label").join(labels, "doc", "left").withColumn("label", F.coalesce("label", "doc"))

    def verify(self, pairs: DataFrame, cut: DataFrame) -> tuple[int, int]:
        """Try pairs (a written table), merge what links; how many were tried and how many linked."""
        self.tried = pairs.select("a", "b") if self.tried is None else self.tried.unionByName(pairs.select("a", "b"))
        found = T.written(linked(pairs, cut), self.spark, "links", measure=True)
        n = self.merge(found)
        T.release(self.spark)
        return pairs._tidemark_rows, n

    def merge(self, found: DataFrame) -> int:
        """Merge the components of these links; how many there are."""
        n = found._tidemark_rows if hasattr(found, "_tidemark_rows") else found.count()
        if n and self.labels is None:
            self.labels = T.written(components(found, self.spark), self.spark, "labels", measure=True)
        elif n:
            # Links join components, so only these go through the steps again.
            ends = self.labelled(found.withColumnRenamed("a", "doc")).select(F.col("label").alias("a"), F.col("b").alias("doc"))
            ends = self.labelled(ends).select("a", F.col("label").alias("b"))
            roots = components(ends, self.spark).toDF("label", "root")
            roots, _ = broadcast_if_small(roots)
            older = self.labels
            moved = older.join(roots, "label", "left").select("doc", F.coalesce("root", "label").alias("label"))
            # What was a root, or had no link until now, hangs on the new one.
            self.labels = T.written(moved.unionByName(roots.toDF("doc", "label")), self.spark, "labels", measure=True)
            T.drop(older)
        return n

    def untried(self, pairs: DataFrame) -> DataFrame:
        """Pairs that were not tried in either order."""
        if self.tried is not None:
            known = self.tried.select(F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b")).distinct()
            pairs = pairs.withColumns({"_a": F.least("a", "b"), "_b": F.greatest("a", "b")}).join(known, ["_a", "_b"], "left_anti").drop("_a", "_b")
        return T.written(pairs, self.spark, "pairs", measure=True)


def near_rows(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, version, n, node, label, component_id)``, one row per row; ``version`` is the text's hash."""
    B.small_batches(spark)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(T.whole(text)).alias("version"))
    types = "doc_id bigint, version bigint, n bigint, node bigint, below bigint, head array<bigint>, ranks array<bigint>"
    sets = T.written(docs.mapInArrow(_sets, types), spark, "shingle-sets")
    nodes = _Nodes(docs, sets, spark)
    own = nodes.own
    everything = own.select("doc", F.explode("head").alias("t"))
    shared = everything.groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("t")
    found = T.written(everything.join(shared, "t"), spark, "shingle-shared")
    last = F.element_at("head", _prefix(F.col("n")).cast("int")).alias("last")
    able = T.written(able_by_head(found, own.select("doc", "n", "below", last)), spark, "able")
    places, _ = broadcast_if_small(able.select("doc", "n", "last", "shared"))
    ranked = T.written(found.join(places, "doc").filter("t <= last").select("t", "doc", "n", "shared"), spark, "shingle-postings")
    T.drop(found, able)

    cut = nodes.fragments(ranked.select("doc").distinct())
    T.release(spark)
    while True:
        pairs = T.written(hub_pairs(nodes.labelled(ranked), nodes.tried), spark, "hub-pairs", measure=True)
        tried, hits = nodes.verify(pairs, cut)
        if hits * 4 <= tried:
            break

    labelled = T.written(nodes.labelled(ranked).select("t", "doc", "n", "label"), spark, "labelled")
    T.drop(ranked)
    open_docs = labelled.join(unresolved(labelled).select("t"), "t", "left_semi").select("doc", "n", "label").distinct()
    open_docs = T.written(open_docs, spark, "open-documents")
    caps, _ = broadcast_if_small(T.written(able_by_set(cut, open_docs, spark), spark, "caps", measure=True))
    capped = T.written(labelled.join(caps, "doc"), spark, "labelled")
    T.drop(labelled, open_docs)
    T.release(spark)
    # The grid point at or before the prefix's last element.
    point = F.shiftright(F.element_at("head", _prefix(F.col("n")).cast("int")), 57).cast("int") + 64
    grid = own.select("doc", "ranks", F.least(point, F.lit(GRID - 1)).alias("q"))

    def crowded() -> tuple[DataFrame, DataFrame]:
        """Postings of open n-grams with few documents, and per document its crowded ones, by the
        components of now."""
        now = nodes.labelled(capped)
        grams = T.written(unresolved(now), spark, "open-grams")
        packed = now.join(grams.filter("NOT few").select("t"), "t", "left_semi")
        counted = T.written(packed.groupBy("doc", "label", "n", "cap").agg(F.count(F.lit(1)).alias("h")), spark, "crowded", measure=True)
        counted, _ = broadcast_if_small(counted)
        crowding = T.written(grid.join(counted, "doc").select("doc", "label", "n", "cap", "h", "ranks", "q"), spark, "crowding")
        return now.join(grams.filter("few").select("t"), "t", "left_semi"), crowding

    few, crowding = crowded()
    nodes.verify(nodes.untried(light_pairs(few, crowding)), cut)
    T.drop(crowding)
    _, crowding = crowded()
    T.release(spark)
    nodes.merge(crowded_links(crowding, cut, spark))
    T.drop(crowding)
    T.release(spark)
    T.drop(cut, capped)
    labels = nodes.labelled(sets.select("doc_id", "version", "n", F.col("node").alias("doc")))
    rows = T.written(labels.withColumnRenamed("doc", "node"), spark, "near-rows")
    least = rows.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("_least"))
    least, _ = broadcast_if_small(T.written(least, spark, "component-ids", measure=True))
    T.drop(sets)
    component = F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("doc_id"))
    return rows.join(least, "label", "left").select("doc_id", "version", "n", "node", "label", component.alias("component_id"))


def near_groups(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per document."""
    return near_rows(docs, spark, doc_id, text).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row with the smallest id. Rows
    without a word stay, as they are in no component."""
    rows = T.written(near_rows(docs, spark, doc_id, text).filter("n > 0"), spark, "near-rows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")
    chosen = rows.groupBy("label").agg(F.min(place).alias("_kept"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    chosen, _ = broadcast_if_small(T.written(chosen.select("label", "_kept"), spark, "near-kept", measure=True))
    gone = rows.join(chosen, "label").filter(place != F.col("_kept")).select(F.col("doc_id").alias("_gone"), F.col("version").alias("_gone_version"))
    gone, _ = broadcast_if_small(T.written(gone.distinct(), spark, "near-copies"))
    version = F.xxhash64(T.whole(text))
    mine = F.col(doc_id).cast("bigint").eqNullSafe(F.col("_gone")) & (version == F.col("_gone_version"))
    kept = docs.join(gone, mine, "left_anti")
    # The same id and text several times: one of the rows stays.
    twice = rows.groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id", "version")
    if twice.isEmpty():
        return kept
    again = twice.toDF("_again", "_again_version")
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col("_again")) & (version == F.col("_again_version"))
    return kept.join(again, same, "left_anti").unionByName(
        kept.join(again, same, "left_semi").withColumn("_version", version).dropDuplicates([doc_id, "_version"]).drop("_version")
    )
