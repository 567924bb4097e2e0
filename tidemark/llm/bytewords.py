"""Words of many texts at once: numpy arrays over the UTF-8 bytes of a batch.

Tasks call this from ``mapInArrow``; memory is bounded by a block of BLOCK bytes, or by one
text where that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession

from tidemark.llm.text import ship

BLOCK = 1 << 20
_RNG = np.random.default_rng(1729)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8: swaps of bytes change the sum
_INVERSE = pow(_BASE, -1, 1 << 64)
IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def small_batches(spark: SparkSession) -> None:
    """Rows per Arrow batch: texts are large. Workers get the package where they lack it."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, BLOCK + 1)
_INVERSES = _powers(_INVERSE, BLOCK + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(block: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of a block of bytes."""
    n = len(block)
    up, down = (_POWERS, _INVERSES) if n <= BLOCK else (_powers(_BASE, n), _powers(_INVERSE, n))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[block] * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def blocks(texts: list[str | None], pad: bytes = b" ") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, offsets)`` of runs of texts of about BLOCK bytes; ``pad`` stands
    before the first and after every text. ``offsets[i]`` is where text first + i begins, the
    last offset is where another would."""
    first, size, parts = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if parts and size + len(raw) >= BLOCK - (len(parts) + 2) * len(pad):
            yield first, i, *_joined(parts, pad)
            first, size, parts = i, 0, []
        parts.append(raw)
        size += len(raw)
    if parts:
        yield first, len(texts), *_joined(parts, pad)


def _joined(parts: list[bytes], pad: bytes) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(pad + pad.join(parts) + pad, dtype=np.uint8)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    return buf, len(pad) + np.concatenate([[0], np.cumsum(lengths + len(pad))])


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; the buffer begins and ends with a blank."""
    space = IS_SPACE[buf]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    return edges[0::2], edges[1::2]


def hashed_words(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, text index per word from 0, word hash)`` of lower-cased words."""
    for first, last, buf, offsets in blocks(texts):
        buf = LOWER[buf]
        starts, ends = word_spans(buf)
        yield first, last, np.searchsorted(offsets, starts, "right") - 1, span_hashes(buf, starts, ends)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts summed per distinct key, in order of the keys."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], np.add.reduceat(counts, first)) if len(keys) else (keys, counts)
