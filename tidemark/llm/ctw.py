"""Context-tree weighting over bytes, trained on a corpus and then frozen.

Every byte is coded as eight binary decisions, each at a node of a binary tree over the byte
values. Each node has context trees of its own: the contexts are the 0 to ``depth`` bytes
before, and a context keeps Krichevsky-Trofimov counts of zeros and ones. The weighted
probability of a context is half its own estimate plus half the product over its one byte
longer contexts. After training, a decision's probability mixes the estimates of all depths
with the weights that the tree has learned; a context never seen says one half. A text's
score is the log10 probability of its bytes (A-Z lower-cased), its code length per byte
follows from it.

Spark counts the corpus: tasks count byte n-grams and words, the counts are summed by key.
n-grams of held-out texts stand in the tree with count 0, where every estimate is one half.
The tree is summed from the leaves. Contexts longer than a cut are summed in runs of rows that
share their last bytes; the cut is the shortest at which no such group has more than
GROUP_GRAMS n-grams, or one byte less than the depth, where a group has 65,536 at most. From
the cut up, block probabilities are summed level by level by the shorter context. The result,
one log10 probability per n-gram, is broadcast when it measures at most TABLE_BYTES; otherwise
the documents' n-grams are joined with it. Word counts are used in the same way: the most
frequent WORDS_KEPT words at most are broadcast, all other words of the documents are joined.

Nulls: a null text is an empty one with score 0; a null id counts as the text ''. An empty
table, or one without training documents, gives every decision one half. Words and contexts
are told apart by 64-bit hashes and bytes. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import bytewords as B
from tidemark.llm import text as T

#: Bytes of context of the registered query; an n-gram of up to seven and the next byte is 64 bits.
DEPTH = 6
#: n-grams that one task holds at once, and those that share the last bytes of their context at most.
CHUNK, GROUP_GRAMS = 1 << 16, 1 << 17
TABLE_BYTES = 256 * 1024 * 1024
WORDS_KEPT = 1 << 20
_WORD, _GRAM, _END = 0, 1, 2
_FLUSH = 1_000_000


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def grams_of(texts: list[str | None], depth: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first, last, grams, is text, offsets)``: the ``depth`` bytes before and each byte, packed."""
    for first, last, buf, offsets in B.blocks(texts, b"\0" * depth):
        b = B.LOWER[buf].astype(np.uint64)
        gram = b[depth:].copy()
        for back in range(1, depth + 1):
            gram |= b[depth - back : len(b) - back] << np.uint64(8 * back)
        text = np.ones(len(gram), dtype=bool)
        for k in range(depth):
            text[offsets[1:] - 2 * depth + k] = False
        yield first, last, gram, text, offsets[:-1] - depth


def _counts(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {_WORD: [], _GRAM: []}
    documents = 0

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(keys), kind, dtype=np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(keys.astype(np.int64)), pa.array(n)], names=["kind", "key", "n"])

    def put(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = held[kind]
        parts.append((keys, n))
        # Pairs of parts are merged as they grow, so a part is merged few times.
        while len(parts) > 1 and len(parts[-1][0]) * 2 > len(parts[-2][0]):
            (k2, n2), (k1, n1) = parts.pop(), parts.pop()
            parts.append(B.merged(np.concatenate([k1, k2]), np.concatenate([n1, n2])))
        if sum(len(k) for k, _ in parts) > _FLUSH:
            yield from (rows(kind, k, c) for k, c in parts)
            parts.clear()

    for batch in batches:
        both = {False: [], True: []}
        for text, held_out in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            both[held_out].append(text)
        documents += len(both[False])
        for _, _, _, h in B.hashed_words(both[False]):
            keys, n = np.unique(h.view(np.int64), return_counts=True)
            yield from put(_WORD, keys, n)
        for held_out, texts in both.items():
            for _, _, gram, text, _ in grams_of(texts, depth):
                keys, n = np.unique(gram[text].view(np.int64), return_counts=True)
                yield from put(_GRAM, keys, n * 0 if held_out else n)
    for kind, parts in held.items():
        yield from (rows(kind, k, c) for k, c in parts)
    if documents:
        yield rows(_END, np.zeros(1, dtype=np.int64), np.array([documents]))


def corpus_counts(docs: DataFrame, spark: SparkSession, depth: int) -> DataFrame:
    """``(kind, key, n)`` over all training texts, with n-grams of the others at 0, as a table."""
    counted = docs.select("text", "held_out").mapInArrow(lambda batches: _counts(batches, depth), "kind int, key bigint, n bigint")
    return T.written(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), spark, "lm-counts")


def log_gamma(x, log=np.log):
    """ln gamma(x) for x > 0, by Stirling's series at x + 8; of arrays, or of columns with their log."""
    z = x + 8
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    half = 0.5 * float(np.log(2 * np.pi))
    return (z - 0.5) * log(z) - z + half + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - log(product)


def estimates(zeros, ones, log=np.log):
    """``(ln of the block probability, probability of a one)`` of decisions."""
    block = log_gamma(zeros + 0.5, log) + log_gamma(ones + 0.5, log) - float(np.log(np.pi)) - log_gamma(zeros + ones + 1, log)
    return block, (ones + 0.5) / (zeros + ones + 1)


def weigh(own: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ln weighted probability, weight of the own estimate)`` from ln of the own block
    probability and ln of the product over the longer contexts."""
    both = np.logaddexp(own, longer)
    return both - np.log(2), np.exp(own - both)


@dataclass
class Level:
    """The decisions of all contexts of one length: ``key`` is context, then node."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray  # ln
    p: np.ndarray  # of a one, by the own counts
    weight: np.ndarray  # of the own estimate


def _subtrees(grams: np.ndarray, n: np.ndarray, depth: int, cut: int) -> tuple[list[Level], list[np.ndarray], np.ndarray]:
    """Levels from ``depth`` down to ``cut`` bytes, the rows of the shorter level (of the first
    level: per decision and n-gram) in each, and the bits decided."""
    steps, byte = np.arange(8, dtype=np.uint64)[:, None], grams & np.uint64(255)
    bit = (byte >> (np.uint64(7) - steps)) & np.uint64(1)
    node = (byte | np.uint64(256)) >> (np.uint64(8) - steps)
    key, at = np.unique(((grams & ~np.uint64(255)) | node).ravel(), return_inverse=True)
    ones, all_ = np.bincount(at, (n * bit).ravel()), np.bincount(at, np.tile(n, 8))
    zeros = all_ - ones
    own, p = estimates(zeros, ones)
    levels, rows = [Level(key, zeros, ones, own, p, np.ones(len(key)))], [at]
    for d in range(depth - 1, cut - 1, -1):
        last = levels[-1]
        key, at = np.unique(last.key & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
        zeros, ones = np.bincount(at, last.zeros), np.bincount(at, last.ones)
        own, p = estimates(zeros, ones)
        weighted, weight = weigh(own, np.bincount(at, last.weighted))
        levels.append(Level(key, zeros, ones, weighted, p, weight))
        rows.append(at)
    return levels, rows, bit


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of batches in order of the first one, CHUNK rows or so with whole groups."""
    parts: list[list[np.ndarray]] = []
    held = 0
    for batch in batches:
        if batch.num_rows:
            parts.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            held += batch.num_rows
            if held >= CHUNK and parts[0][0][0] != parts[-1][0][-1]:
                columns = [np.concatenate(c) for c in zip(*parts)]
                end = np.searchsorted(columns[0], columns[0][-1])
                yield [c[:end] for c in columns]
                parts, held = [[c[end:] for c in columns]], held - end
    if parts:
        yield [np.concatenate(c) for c in zip(*parts)]


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _up(depth: int, cut: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, key, n in _whole_groups(batches):
            top = _subtrees(key.view(np.uint64), n.astype(float), depth, cut)[0][-1]
            context, node = (top.key >> np.uint64(8)).astype(np.int64), (top.key & np.uint64(255)).astype(np.int32)
            yield _batch(context=context, node=node, zeros=top.zeros, ones=top.ones, weighted=top.weighted)

    return run


def _down(depth: int, cut: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for top, key, n, said, left in _whole_groups(batches):
            above = n < 0
            grams = key[~above].view(np.uint64)
            levels, rows, bit = _subtrees(grams, n[~above].astype(float), depth, cut)
            order = np.argsort(top[above] << 8 | key[above])
            a, b = said[above][order], left[above][order]
            for i in range(len(levels) - 1, -1, -1):
                a, b = a + b * levels[i].weight * levels[i].p, b * (1 - levels[i].weight)
                a, b = a[rows[i]], b[rows[i]]
            one = a.reshape(8, -1)
            yield _batch(key=grams.view(np.int64), log10=np.log10(np.where(bit == 1, one, 1 - one)).sum(axis=0))

    return run


def _last_bytes(key: Column, n: int) -> Column:
    return key.bitwiseAND(F.lit((1 << 8 * n) - 1).cast("bigint"))


def _cut(grams: DataFrame, depth: int, most: int) -> int:
    """Bytes of context that a group shares, so that it has at most ``most`` n-grams if possible."""
    for cut in range(min(2, depth - 1), depth - 1):
        if (grams.groupBy(_last_bytes(F.shiftright("key", 8), cut)).count().agg(F.max("count")).first()[0] or 0) <= most:
            return cut
    return depth - 1


def train(counts: DataFrame, spark: SparkSession, depth: int, group_grams: int = GROUP_GRAMS) -> DataFrame:
    """``(key, log10)`` of every n-gram in ``counts``."""
    grams = counts.filter(F.col("kind") == _GRAM).select("key", "n")
    cut = _cut(grams, depth, group_grams)
    grams = grams.select(_last_bytes(F.shiftright("key", 8), cut).alias("top"), "key", "n")
    runs = grams.repartition("top").sortWithinPartitions("top")
    levels = {cut: T.written(runs.mapInArrow(_up(depth, cut), "context bigint, node int, zeros double, ones double, weighted double"), spark, "lm-tree")}
    for d in range(cut - 1, -1, -1):
        sums = levels[d + 1].groupBy(_last_bytes(F.col("context"), d).alias("context"), "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("longer")
        )
        own, p = estimates(F.col("zeros"), F.col("ones"), F.ln)
        both = F.greatest("own", "longer") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("longer"))))
        level = sums.withColumns({"own": own, "p": p}).withColumn("both", both)
        level = level.withColumns({"weighted": F.col("both") - float(np.log(2)), "weight": F.exp(F.col("own") - F.col("both"))})
        levels[d] = T.written(level.drop("own", "longer", "both"), spark, "lm-tree")
    # What the shorter contexts say of a decision, and the share they leave to the longer ones.
    above = None
    for d in range(cut):
        said, left = F.col("weight") * F.col("p"), 1 - F.col("weight")
        if above is None:
            level = levels[d].select("context", "node", said.alias("said"), left.alias("left"))
        else:
            level = _below(levels[d], above, d).select(
                "context", "node", (F.col("said") + F.col("left") * said).alias("said"), (F.col("left") * left).alias("left")
            )
        above = T.written(level, spark, "lm-mix")
    if above is None:
        above = levels[cut].select("context", "node", F.lit(0.0).alias("said"), F.lit(1.0).alias("left"))
    else:
        above = _below(levels[cut], above, cut).select("context", "node", "said", "left")
    rows = grams.select("top", "key", "n", F.lit(0.0).alias("said"), F.lit(0.0).alias("left")).unionByName(
        above.select(F.col("context").alias("top"), F.col("node").cast("bigint").alias("key"), F.lit(-1).cast("bigint").alias("n"), "said", "left")
    )
    runs = rows.repartition("top").sortWithinPartitions("top")
    table = runs.mapInArrow(_down(depth, cut), "key bigint, log10 double")
    # Rounded here, so that a score is the same whether the table is broadcast or joined.
    return T.written(table.select("key", F.col("log10").cast("float")), spark, "lm-table")


def _below(level: DataFrame, above: DataFrame, d: int) -> DataFrame:
    """The contexts of ``d`` bytes with what is said above them."""
    rows = level.withColumn("shorter", _last_bytes(F.col("context"), d - 1))
    return rows.join(above.select(F.col("context").alias("shorter"), "node", "said", "left"), ["shorter", "node"])


class Lookup:
    """The table as arrays: log10 probabilities of n-grams."""

    def __init__(self, table: pa.Table):
        keys = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], table.column("log10").to_numpy()[order]

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        keys, at = np.unique(grams, return_inverse=True)
        return self.values[np.searchsorted(self.keys, keys)][at]


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, offsets)


def _scores(shared, depth: int, keep_grams: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(uid, doc_id, held_out, n_words, known, base, rare, n_bytes, score)``, and with
    ``keep_grams`` the text's distinct n-grams and counts instead of a score."""

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        lookup, words, terms = shared.value
        texts = batch.column(3).to_pylist()
        out: dict[str, list] = {k: [] for k in ("n_words", "known", "base", "n_bytes", "score")}
        rare, grams, counts = [], [], []
        for first, last, at, h in B.hashed_words(texts):
            n, h = last - first, h.view(np.int64)
            i = np.minimum(np.searchsorted(words, h), max(0, len(words) - 1))
            hit = words[i] == h if len(words) else np.zeros(len(h), dtype=bool)
            out["n_words"].append(np.bincount(at, minlength=n))
            out["known"].append(np.bincount(at[hit], minlength=n))
            out["base"].append(np.bincount(at[hit], weights=terms[i[hit]] if len(words) else None, minlength=n).astype(float))
            rare += np.split(h[~hit], np.searchsorted(at[~hit], np.arange(1, n)))
        for first, last, gram, text, offsets in grams_of(texts, depth):
            ends = np.append(offsets[1:], len(gram)) - depth
            out["n_bytes"].append(ends - offsets)
            if keep_grams:
                out["score"].append(np.zeros(last - first))
                for a, b in zip(offsets, ends):
                    keys, n = np.unique(gram[a:b], return_counts=True)
                    grams.append(keys.view(np.int64))
                    counts.append(n)
            else:
                values = np.zeros(len(gram))
                values[text] = lookup(gram[text])
                out["score"].append(_per_text(values, offsets))
        columns = {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}
        arrays = [batch.column(0), batch.column(1), batch.column(2)]
        arrays += [pa.array(columns[k].astype(np.int64)) for k in ("n_words", "known", "n_bytes")]
        arrays += [pa.array(columns[k].astype(np.float64)) for k in ("base", "score")]
        arrays += [_list(rare)] + ([_list(grams), _list(counts)] if keep_grams else [])
        return pa.RecordBatch.from_arrays(arrays, names=_SCORED + ["grams", "counts"] * keep_grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(of_batch, batches)

    return run


_SCORED = ["uid", "doc_id", "held_out", "n_words", "known", "n_bytes", "base", "score", "rare"]
_SCORED_TYPES = (
    "uid bigint, doc_id bigint, held_out boolean, n_words bigint, known bigint, n_bytes bigint, "
    "base double, score double, rare array<bigint>"
)


def _list(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int64)))


def _frequent(words: DataFrame, most: int) -> tuple[int, DataFrame]:
    """The least power of two so that at most ``most`` words occur that often, and those."""
    by_bits = words.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).count().collect()
    total, cutoff = 0, 64
    for b, n in sorted(((r["b"], r["count"]) for r in by_bits), reverse=True):
        if total + n > most:
            break
        total, cutoff = total + n, b
    return cutoff, words.filter(F.col("n") >= F.lit(2 ** min(cutoff, 62)))


def score(
    docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text",
    words_kept: int = WORDS_KEPT, table_bytes: int = TABLE_BYTES, depth: int = 3, group_grams: int = GROUP_GRAMS,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)``
    with contexts of up to ``depth`` bytes, 2 to 7."""
    if not 2 <= depth <= 7:
        raise ValueError(f"depth must be 2 to 7, not {depth}")
    B.small_batches(spark)
    docs = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("bigint").alias("doc_id"),
        held_out(doc_id).alias("held_out"), F.col(text).alias("text"),
    )
    counts = corpus_counts(docs, spark, depth)
    totals = {r["kind"]: (r["n"], r["keys"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys")).collect()}
    trained_docs = totals.get(_END, (0, 0))[0]
    train_tokens = totals.get(_WORD, (0, 0))[0] + trained_docs
    distinct = totals.get(_WORD, (0, 0))[1] + (trained_docs > 0)
    norm = train_tokens + 0.1 * (distinct + 1)

    words = counts.filter(F.col("kind") == _WORD).select("key", "n")
    _, often = _frequent(words, words_kept)
    kept = often.toArrow()
    order = np.argsort(kept.column("key").to_numpy())
    keys = kept.column("key").to_numpy()[order]
    terms = np.log10((kept.column("n").to_numpy()[order] + 0.1) / norm)

    table = train(counts, spark, depth, group_grams)
    small = table.count() * 16 <= table_bytes
    lookup = Lookup(table.toArrow()) if small else None
    shared = spark.sparkContext.broadcast((lookup, keys, terms))
    types = _SCORED_TYPES + ("" if small else ", grams array<bigint>, counts array<bigint>")
    scored = T.written(docs.mapInArrow(_scores(shared, depth, not small), types), spark, "lm-scores")

    # Words that were not broadcast: joined with their counts.
    rare = scored.select("uid", F.explode("rare").alias("key")).groupBy("uid", "key").agg(F.count(F.lit(1)).alias("tf"))
    rest = words.join(often, "key", "left_anti") if len(keys) else words
    joined = rare.join(rest.toDF("key", "c"), "key", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    per_doc = joined.groupBy("uid").agg(
        F.sum(F.col("tf") * F.log10((F.col("c") + 0.1) / F.lit(norm))).alias("_base"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("_known"),
    )
    out = scored.join(per_doc, "uid", "left")
    if not small:
        out = out.drop("score").join(_joined_scores(scored, table), "uid", "left")
    bits = -F.coalesce("score", F.lit(0.0)) * float(np.log2(10))
    end = float(np.log10((trained_docs + 0.1) / norm))
    return out.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("_known", F.lit(0)) + int(trained_docs > 0)).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0)) + end).alias("base_score"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _joined_scores(scored: DataFrame, table: DataFrame) -> DataFrame:
    """``(uid, score)`` by joining n-grams with the table: for tables beyond the broadcast."""
    grams = scored.select("uid", F.explode(F.arrays_zip("grams", "counts")).alias("g")).select("uid", F.col("g.grams").alias("key"), F.col("g.counts").alias("n"))
    return grams.join(table, "key").groupBy("uid").agg(F.sum(F.col("n") * F.col("log10").cast("double")).alias("score"))
