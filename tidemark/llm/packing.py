"""Pack tokenized documents into sequences of a fixed window by non-negative least squares.

A document's ids are cut at every full window from its start; what is left over, shorter
than a window, is a piece of its own. Pieces of up to EXACT ids have a bin per length, so short
texts lose nothing; longer ones are rounded up to the next multiple of ``window / BINS``. Every
combination of up to three bins that fills a window exactly is a strategy; how often each is used
comes from non-negative least squares against the histogram of bins, where a bin weighs more the
longer it is. The counts are rounded down, and what they leave is packed greedily, longest first
into what still fits. Only the histogram (EXACT + BINS counts at most) and the plan reach the driver. Each piece then finds its
place by its rank within its bin: the rank within its task was counted as it was made, and
running sums over tasks complete it.

Sequences are padded to the window, except those of a length that is a power of two.

Nulls: a null text is an empty one, and its only id is the end mark. A null document id is
kept. Rows with one id are packed each. An empty table gives no pieces. Other columns stay
behind.
"""

from __future__ import annotations

import functools
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm import bytewords as B
from tidemark.llm import text as T

WINDOW, BINS, EXACT, END_ID = 4096, 256, 256, 2
#: Distinct units whose ids a worker remembers; beyond, it starts anew.
REMEMBERED = 1 << 21
#: Byte classes: blanks, ASCII letters, digits, other ASCII signs; 0 joins with anything.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[c for c in range(33, 127)]] = 3
_CLASS[[c for c in range(48, 58)]] = 2
_CLASS[[c for c in range(97, 123)]] = 1
_CLASS[[ord(c) for c in "'<|"]] = 0


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=2)
def _units(path: str) -> UnitIds:
    return UnitIds(path)


class UnitIds:
    """Ids of texts by units that the tokenizer never joins: it drops white space and splits
    between letters, digits and signs. Units are told apart by 64-bit hash; those that hold an
    apostrophe, a mark of a special token or a character beyond ASCII stay whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode
        self.ends_word = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
        self.ends_word[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint32)

    def _learn(self, buf: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = buf.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts, ends)]
        # A unit of letters alone is one word to the tokenizer, so many can be encoded at once
        # and parted after each id that ends a word.
        alone = [unicodedata.normalize("NFC", t).lower().isalpha() for t in texts]
        ids: list[list[int]] = [[]] * len(texts)
        plain = [i for i, one in enumerate(alone) if one]
        for at in range(0, len(plain), 5000):
            some = plain[at : at + 5000]
            flat = np.array(self._ids(" ".join(texts[i] for i in some)), dtype=np.uint32)
            parts = np.split(flat, np.flatnonzero(self.ends_word[flat]) + 1)[:-1]
            if len(parts) != len(some):
                parts = [self._ids(texts[i]) for i in some]
            for i, part in zip(some, parts):
                ids[i] = part
        for i, one in enumerate(alone):
            if not one:
                ids[i] = self._ids(texts[i])
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((i for part in ids for i in part), dtype=np.uint32, count=int(sizes.sum()))
        begins = len(self.pool) + np.cumsum(sizes) - sizes
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.starts = np.concatenate([self.starts, begins])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.pool = np.concatenate([self.pool, flat])

    def _ids(self, text: str) -> list[int]:
        return self.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of every text, END_ID last."""
        for first, last, buf, offsets in B.blocks(texts):
            buf = B.LOWER[buf]
            space, kind = B.IS_SPACE[buf], _CLASS[buf]
            split = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
            begins = np.flatnonzero(~space[1:] & (space[:-1] | split)) + 1
            ends = np.flatnonzero(~space[:-1] & (space[1:] | split)) + 1
            h = B.span_hashes(buf, begins, ends)
            distinct, where, back = np.unique(h, return_index=True, return_inverse=True)
            if len(self.keys) + len(distinct) > REMEMBERED:
                self.clear()
            at = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
            new = self.keys[at] != distinct if len(self.keys) else np.ones(len(distinct), dtype=bool)
            if new.any():
                self._learn(buf, distinct[new], begins[where[new]], ends[where[new]])
                at = np.searchsorted(self.keys, distinct)
            starts, sizes = self.starts[at][back], self.sizes[at][back]
            done = np.cumsum(sizes)
            flat = self.pool[np.repeat(starts - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)]
            # Where each text's ids end among all ids of the block.
            cuts = np.concatenate([[0], done])[np.searchsorted(begins, offsets)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield np.append(flat[a:b], np.uint32(END_ID)).astype("<u4")


def bin_lengths(window: int = WINDOW, bins: int = BINS, exact: int = EXACT) -> np.ndarray:
    """The length of every bin, ascending; bin 0 has length 0 and stays unused."""
    step = -(-window // bins)
    exact = min(window, -(-exact // step) * step)
    return np.concatenate([np.arange(exact + 1), np.arange(exact + step, window, step), [window] * (exact < window)]).astype(np.int64)


def _pieces(path: str, window: int, lengths: np.ndarray):
    """``(doc_id, start, length, ids_crc32, doc_tokens, bin, task, nth)``: pieces with their
    rank among those of their task and bin."""
    bin_of = np.searchsorted(lengths, np.arange(window + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, units = TaskContext.get().partitionId(), _units(path)
        used = np.zeros(len(lengths), dtype=np.int64)
        for batch in batches:
            doc_ids, rows, own = batch.column(0), [], []
            for i, ids in enumerate(units.ids(batch.column(1).to_pylist())):
                n, raw = len(ids), ids.tobytes()
                for start in range(0, n, window):
                    length = min(window, n - start)
                    b = bin_of[length]
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    rows.append((start, length, crc, n, b, used[b]))
                    own.append(i)
                    used[b] += 1
            table = np.array(rows, dtype=np.int64).reshape(-1, 6)
            columns = [doc_ids.take(pa.array(own, pa.int64()))] + [pa.array(table[:, k]) for k in range(6)]
            columns.append(pa.array(np.full(len(rows), task, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin", "nth", "task"]
            )

    return run


def strategies(lengths: np.ndarray) -> np.ndarray:
    """All combinations of one, two or three bins whose lengths sum to the longest; rows are
    longest first and filled up with zeros."""
    window = int(lengths[-1])
    bin_of = np.full(window + 1, -1, dtype=np.int64)
    bin_of[lengths] = np.arange(len(lengths))
    third, second = np.triu_indices(len(lengths))  # third <= second; 0 stands for none
    rest = window - lengths[second] - lengths[third]
    first = np.where(rest >= lengths[second], bin_of[np.maximum(rest, 0)], -1)
    fits = first > 0
    return np.stack([first[fits], second[fits], third[fits]], axis=1)


def least_squares(combos: np.ndarray, histogram: np.ndarray, lengths: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that minimises the weighted squares of ``A x - histogram`` by accelerated
    projected gradients. A has a column per strategy; the weight of a bin grows with its
    length, since long pieces are the hard ones to place."""
    bins = len(histogram) - 1
    weight = np.sqrt(lengths / lengths[-1])
    target = histogram / max(1, histogram.max())

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.zeros(bins + 1)
        for k in range(combos.shape[1]):
            out += np.bincount(combos[:, k], weights=x, minlength=bins + 1)
        out[0] = 0
        return out * weight

    def backward(r: np.ndarray) -> np.ndarray:
        r = r * weight
        r[0] = 0
        return sum(r[combos[:, k]] for k in range(combos.shape[1]))

    # The largest eigenvalue of A'A, by power iteration.
    v = np.ones(len(combos))
    for _ in range(30):
        v = backward(forward(v))
        top = np.linalg.norm(v)
        v = v / top
    x = y = np.zeros(len(combos))
    momentum, goal = 1.0, target * weight
    for _ in range(steps):
        new = np.maximum(0, y - backward(forward(y) - goal) / (1.05 * top))
        faster = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y = new + (momentum - 1) / faster * (new - x)
        x, momentum = new, faster
    return x * max(1, histogram.max())


def plan(histogram: np.ndarray, lengths: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """``(bins of one sequence, longest first; how many sequences)`` covering the histogram
    exactly. ``histogram[b]`` counts the pieces of bin b; bin 0 is unused."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def use(combo: tuple[int, ...], n: int) -> None:
        if n > 0:
            out.append((combo, int(n)))
            for b in combo:
                left[b] -= n

    def most(combo: tuple[int, ...]) -> int:
        return min(left[b] // combo.count(b) for b in set(combo))

    combos = strategies(lengths)
    repeats = np.floor(least_squares(combos, histogram, lengths)).astype(np.int64)
    for i in np.argsort(-repeats, kind="stable"):
        if repeats[i] == 0:
            break
        combo = tuple(int(b) for b in combos[i] if b)
        use(combo, min(repeats[i], most(combo)))
    while left.any():
        combo, room = [], int(lengths[-1])
        for b in np.flatnonzero(left)[::-1].tolist():
            n = min(int(left[b]), room // int(lengths[b]))
            combo += [b] * n
            room -= n * int(lengths[b])
        use(tuple(combo), most(tuple(combo)))
    return out


def _places(layout: list[tuple[tuple[int, ...], int]], n_bins: int) -> list[tuple[np.ndarray, ...]]:
    """Per bin: first rank, first sequence and slot of every run of places, by rank."""
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(n_bins)]
    used, sequence = [0] * n_bins, 0
    for combo, n in layout:
        for slot, b in enumerate(combo):
            runs[b].append((used[b], sequence, slot))
            used[b] += n
        sequence += n
    return [tuple(np.array(c, dtype=np.int64) for c in zip(*r)) if r else () for r in runs]


def _placed(places: list[tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bin_, rank = batch.column("bin").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for b in np.unique(bin_):
                at = np.flatnonzero(bin_ == b)
                first, sequences, slots = places[b]
                i = np.searchsorted(first, rank[at], "right") - 1
                sequence[at], slot[at] = sequences[i] + rank[at] - first[i], slots[i]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(slot)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "slot"])

    return run


def pack(
    docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text",
    path: str | None = None, window: int = WINDOW, bins: int = BINS,
) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    padded_length)``."""
    B.small_batches(spark)
    lengths = bin_lengths(window, bins)
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    types = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    made = own.mapInArrow(_pieces(path or tokenizer_path(), window, lengths), types + ", bin bigint, nth bigint, task bigint")
    pieces = T.written(made, spark, "pack-pieces")

    per_task = T.written(pieces.groupBy("bin", "task").agg(F.count(F.lit(1)).alias("n")), spark, "pack-counts")
    histogram = np.zeros(len(lengths), dtype=np.int64)
    for r in per_task.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        histogram[r["bin"]] = r["n"]
    before = Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("bin", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(starts, ["bin", "task"]).withColumn("rank", F.col("_before") + F.col("nth")).drop("_before", "nth", "task")
    placed = ranked.mapInArrow(_placed(_places(plan(histogram, lengths), len(lengths))), types + ", sequence_id bigint, slot bigint")
    # A sequence holds at most `window` pieces.
    in_sequence = Window.partitionBy("sequence_id")
    earlier = in_sequence.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.sum("length").over(in_sequence)
    power = F.bit_count(filled) == 1
    return placed.withColumns(
        {
            "offset": F.coalesce(F.sum("length").over(earlier), F.lit(0)),
            "padded_length": F.when(power, filled).otherwise(F.lit(window).cast("bigint")),
        }
    ).drop("slot")
