"""Rank documents for a stated set of items by dual-tree search, exactly.

Terms are runs of ASCII letters, digits and characters beyond ASCII. With N documents that have
a term, L their terms, n a document's terms and tf a term's occurrences in it, a document's
coordinate of a term is ``(10^9 tf) div (1000 tf + 8 m)``, ``m = 10 + (90 n N) div L``; an item
weighs its terms by ``floor(1000 ln((2N + 2) / (2 df + 1)))``. A score is their inner product.

Two hierarchies hold coordinate maxima. Items are ordered by their heaviest terms and joined
FAN at a time; a node knows the terms of all its items. Each task orders the documents of a
chunk by the coordinate that weighs most and joins them FAN at a time over leaves of LEAF;
a node knows the greatest coordinate of each term. The inner product of a pair of nodes bounds
every score below it. Where it is less than the weakest k-th score of the items below, the whole
batch of pairs goes; a bound that equals it stays, as ties go to the smaller document id. All
numbers are whole and below 2^53, so bounds and scores are exact.

1. One pass over the texts writes, per document, its terms that some item has, with N, L and df
   as aggregates of that table.
2. Every chunk scores the most promising leaf of each item. The k-th best of all chunks is a
   score that k documents reach, so it is a valid bound to start from.
3. The search runs over all chunks, and at most k rows per item and task are merged.

Documents never move between tasks: what is shuffled is k rows per item and task. Items pass
the driver and are broadcast in blocks of about BLOCK_BYTES of terms; more items mean more
passes. A worker holds one chunk, at most CELLS coordinates.

Nulls: a null text has no terms, such a document is in no result, such an item has none. A null
document id comes after all others of its score; rows with one document id are ranked each. Every
row of items is an item of its own, also where ids are null or repeated. Empty texts and items whose
terms occur nowhere have no results, empty tables give none. Length is not limited. Other columns
stay behind, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm import text as T

#: Fixed value of the term rule: everything that is no ASCII letter, digit or beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP, FAN, LEAF = 10, 8, 16
#: Bytes of terms of the items that are searched in one pass, and coordinates of a chunk.
BLOCK_BYTES, CELLS, CHUNK = 4 << 20, 8 << 20, 4096
_FIND = re.compile(TERM)
_LOWER = str.maketrans(T.UPPER, T.UPPER.lower())


def terms_of(text: Column) -> Column:
    """All terms of a text, A-Z in lower case."""
    return F.regexp_extract_all(T.lower_ascii(T.whole(text)), F.lit(TERM), F.lit(0))


def _vectors(shared):
    """``doc_id, text`` to ``doc_id, n, terms, tfs``: the terms that are in the shared vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            sizes, offsets, terms, tfs = [], [0], [], []
            for text in batch.column(1):
                found = _FIND.findall((text.as_py() or "").translate(_LOWER))
                held = Counter(found)
                for term in number.keys() & held.keys():
                    terms.append(number[term])
                    tfs.append(held[term])
                sizes.append(len(found))
                offsets.append(len(terms))
            cuts = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(cuts, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(tfs, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return run


class ItemTree:
    """Items in the order of their heaviest terms; ``levels[0]`` are the items, the last is one node.

    A node is ``(first item, item after the last, terms, weights)``.
    """

    def __init__(self, uids: Sequence[int], terms: Sequence[Sequence[int]], weights: np.ndarray):
        heaviest = [sorted((int(t) for t in ts), key=lambda t: (-weights[t], t)) for ts in terms]
        order = sorted(range(len(uids)), key=lambda i: heaviest[i])
        self.uids = np.array([uids[i] for i in order], dtype=np.int64)
        self.weights = weights
        self.levels = [[self._node(i, i + 1, np.unique(np.array(heaviest[o], dtype=np.int64))) for i, o in enumerate(order)]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            groups = (below[at : at + FAN] for at in range(0, len(below), FAN))
            self.levels.append([self._node(g[0][0], g[-1][1], np.unique(np.concatenate([n[2] for n in g]))) for g in groups])

    def _node(self, first: int, last: int, terms: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        return first, last, terms, self.weights[terms].astype(np.float64)


class DocTree:
    """One chunk of documents: ``levels[0]`` their coordinates, then maxima of leaves and of
    FAN nodes each, up to one node."""

    def __init__(self, sizes: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], corpus: tuple[int, int], weights: np.ndarray):
        documents, total = corpus
        rows = np.repeat(np.arange(len(sizes)), [len(t) for t in terms])
        columns = np.concatenate(terms).astype(np.int64)
        tf = np.concatenate(tfs).astype(np.int64)
        m = 10 + (90 * sizes * documents) // total
        matrix = np.zeros((len(sizes), len(weights)), dtype=np.float32)
        matrix[rows, columns] = (1_000_000_000 * tf) // (1000 * tf + 8 * m[rows])
        self.order = np.argsort((matrix * weights.astype(np.float32)).argmax(axis=1), kind="stable")
        self.levels = [matrix[self.order]]
        width = LEAF
        while len(self.levels) == 1 or len(self.levels[-1]) > 1:
            starts = np.arange(0, len(self.levels[-1]), width)
            self.levels.append(np.maximum.reduceat(self.levels[-1], starts, axis=0))
            width = FAN

    def bounds(self, level: int, nodes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self.levels[level][np.ix_(nodes, terms)].astype(np.float64) @ weights

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        width = LEAF if level == 1 else FAN
        children = (nodes[:, None] * width + np.arange(width)).ravel()
        return children[children < len(self.levels[level - 1])]


class Search:
    """The best ``k`` documents of every item over the chunks of a task; ``floor`` are scores that
    ``k`` documents are known to reach."""

    def __init__(self, tree: ItemTree, k: int, floor: np.ndarray | None = None):
        self.tree, self.k = tree, k
        self.best: list[list[tuple]] = [[] for _ in tree.uids]
        self.limit = np.ones(len(tree.uids)) if floor is None else np.maximum(floor, 1.0)
        self.scored = 0

    def _take(self, item: int, docs: DocTree, rows: np.ndarray, ids: list) -> None:
        """Score documents of the chunk for one item."""
        _, _, terms, weights = self.tree.levels[0][item]
        scores = docs.bounds(0, rows, terms, weights)
        self.scored += len(rows)
        enough = scores >= self.limit[item]
        rows, scores = rows[enough], scores[enough]
        if len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            rows, scores = rows[scores >= kth], scores[scores >= kth]
        if not len(scores):
            return
        found = ((-int(s), ids[docs.order[r]] is None, ids[docs.order[r]]) for r, s in zip(rows, scores))
        self.best[item] = sorted([*self.best[item], *found], key=_by_score)[: self.k]
        if len(self.best[item]) == self.k:
            self.limit[item] = max(self.limit[item], -self.best[item][-1][0])

    def seed(self, docs: DocTree, ids: list) -> None:
        """For every item the leaf with the greatest bound."""
        leaves = np.arange(len(docs.levels[1]))
        for item, (_, _, terms, weights) in enumerate(self.tree.levels[0]):
            if len(terms):
                bounds = docs.bounds(1, leaves, terms, weights)
                self._take(item, docs, docs.below(1, leaves[[bounds.argmax()]]), ids)

    def run(self, docs: DocTree, ids: list) -> None:
        top = len(self.tree.levels) - 1
        for node in range(len(self.tree.levels[top])):
            self._visit(top, node, docs, len(docs.levels) - 1, np.arange(len(docs.levels[-1])), ids)

    def _visit(self, height: int, node: int, docs: DocTree, level: int, nodes: np.ndarray, ids: list) -> None:
        """Bound a node of items against nodes of documents, then go down on both sides."""
        first, last, terms, weights = self.tree.levels[height][node]
        if not len(terms):
            return
        bounds = docs.bounds(level, nodes, terms, weights)
        open_ = bounds >= self.limit[first:last].min()
        nodes, bounds = nodes[open_], bounds[open_]
        if not len(nodes):
            return
        if height == 0 and level == 1:
            # Most promising leaves first, so that the k-th score rises early.
            for at in np.argsort(-bounds, kind="stable"):
                if bounds[at] < self.limit[first]:
                    break
                self._take(first, docs, docs.below(1, nodes[[at]]), ids)
            return
        if level > 1:
            nodes, level = docs.below(level, nodes), level - 1
        if height == 0:
            self._visit(0, node, docs, level, nodes, ids)
            return
        for child in range(node * FAN, min((node + 1) * FAN, len(self.tree.levels[height - 1]))):
            self._visit(height - 1, child, docs, level, nodes, ids)

    def results(self) -> list[tuple]:
        return [(int(uid), d, -s) for uid, found in zip(self.tree.uids, self.best) for s, _, d in found]


def _by_score(found: tuple) -> tuple:
    """Highest score, then smallest id; ids that are missing come last and are never compared."""
    score, missing, doc = found
    return (score, missing) if missing else (score, missing, doc)


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches joined and cut to chunks of that many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            take = min(batch.num_rows, rows - sum(b.num_rows for b in held))
            held.append(batch.slice(0, take))
            batch = batch.slice(take)
            if sum(b.num_rows for b in held) == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched(shared, corpus: tuple[int, int], k: int, floor=None):
    """``doc_id, n, terms, tfs`` to ``_uid, doc_id, score``; without a floor only seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        search = Search(tree, k, None if floor is None else floor.value)
        rows = max(LEAF, min(CHUNK, CELLS // max(1, len(tree.weights))))
        kind = pa.int64()
        for chunk in _chunks(batches, rows):
            ids = chunk.column("doc_id")
            kind, ids = ids.type, ids.to_pylist()
            parts = []
            for name in ("terms", "tfs"):
                lists = chunk.column(name).combine_chunks()
                flat, cuts = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *lists.value_lengths().to_pylist()])
                parts.append([flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])])
            docs = DocTree(chunk.column("n").to_numpy(), *parts, corpus, tree.weights)
            search.seed(docs, ids) if floor is None else search.run(docs, ids)
        found = search.results()
        columns = list(zip(*found)) if found else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())],
            names=["_uid", "doc_id", "score"],
        )

    return run


def _search_block(docs: DataFrame, rows: list, spark: SparkSession, k: int) -> DataFrame:
    """The best documents of one block of items (``_uid, terms``), as a table."""
    context = spark.sparkContext
    names = sorted({t for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(names)}
    vocabulary = context.broadcast(number)
    kind = docs.schema["doc_id"].dataType.simpleString()
    vectors = T.written(
        docs.select("doc_id", "text").mapInArrow(_vectors(vocabulary), f"doc_id {kind}, n bigint, terms array<int>, tfs array<int>"),
        spark,
        "term-vectors",
    )
    vocabulary.unpersist()
    size = vectors.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(names), dtype=np.int64)
    # One row per term of the block.
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * size["docs"] + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()])
    # Terms that no document holds add nothing.
    terms = [[number[t] for t in r["terms"] if df[number[t]]] for r in rows]
    tree = context.broadcast(ItemTree([r["_uid"] for r in rows], terms, weights))
    held = vectors.filter(F.size("terms") > 0)
    corpus = (size["docs"], size["terms"] or 1)
    shape = f"_uid bigint, doc_id {kind}, score bigint"
    seeds = _best(held.mapInArrow(_searched(tree, corpus, k), shape), k)
    reached = {r["_uid"]: r["score"] for r in seeds.filter(F.col("rank") == k).select("_uid", "score").collect()}
    floor = context.broadcast(np.array([reached.get(int(u), 0) for u in tree.value.uids], dtype=np.float64))
    found = T.written(_best(held.mapInArrow(_searched(tree, corpus, k, floor), shape), k), spark, "ranked")
    tree.unpersist()
    floor.unpersist()
    return found


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_uid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, spark: SparkSession, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (``doc_id, text``) of every
    item (``item_id, text``), those with a score above 0."""
    T.ship(spark)
    asked = T.written(
        items.select("item_id", F.array_distinct(terms_of(F.col("text"))).alias("terms"), F.monotonically_increasing_id().alias("_uid")),
        spark,
        "items",
    )
    total = asked.agg(F.sum(F.aggregate("terms", F.lit(0).cast("bigint"), lambda n, t: n + 16 + F.octet_length(t)))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    found = None
    for block in range(blocks):
        inside = asked.filter(F.pmod(F.xxhash64("_uid"), F.lit(blocks)) == block)
        rows = inside.select("_uid", "terms").collect()  # about block_bytes
        part = _search_block(docs, rows, spark, k) if rows else None
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        found = spark.createDataFrame([], f"_uid bigint, doc_id {kind}, score bigint, rank int")
    return found.join(asked.select("_uid", "item_id"), "_uid").select("item_id", "rank", "doc_id", "score")
