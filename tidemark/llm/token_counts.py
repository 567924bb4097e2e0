"""Count the tokens of whole texts: whole-token shortcut, merges only for the rest.

A byte-pair tokenizer cuts a text into pre-tokens and merges each by itself. Before any text is
read, every string of the vocabulary is run through the merges alone (:func:`whole_tokens`):
those that end as one token are proven, as a pre-token that equals one of them is always that
token, wherever it stands. Proven pre-tokens are counted directly, only the others are merged.

Where the vocabulary marks word ends, pre-tokens never reach over white space, so a text is cut at
ASCII white space first and the sums of a cut are remembered per task (REMEMBERED at most, then
anew). A cut that holds the string of an added token goes through the library as it is, since such
strings are found before the text is normalised.

One pass, no shuffle: rows stay in their partition and a worker holds one Arrow batch. Nulls: a
null text counts as empty, a null id is kept. Empty texts have 0 tokens; rows with one id are
counted each; an empty table gives no rows; columns other than id and text stay behind, so their
names cannot clash. Length is not limited.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import text as T

#: Longest text, in tokens, that is not over the limit.
LIMIT = 2048
#: Distinct cuts and pre-tokens a worker remembers.
REMEMBERED = 1 << 18
_CUT = re.compile(T.WORD_RUN)


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


class TokenCounter:
    """``(tokens counted directly, tokens that merges gave)`` of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        model = config["model"]
        if model["type"] != "BPE" or model.get("dropout") or self.tokenizer.pre_tokenizer is None:
            raise ValueError(f"{path} is no byte-pair tokenizer whose pre-tokens can be counted apart")
        self.suffix = model.get("end_of_word_suffix") or ""
        marks = [t["content"] for t in config["added_tokens"]]
        self.marked = re.compile("|".join(map(re.escape, marks))).search if marks else lambda _: None
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.normalizer, self.pre_tokenizer = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.merge = self.tokenizer.model.tokenize
        self.whole = whole_tokens(self.tokenizer, self.suffix)
        self.merged: dict[str, int] = {}
        self.sums: dict[str, tuple[int, int]] = {}

    def _pre_tokens(self, text: str) -> tuple[int, int]:
        if self.marked(text):
            return 0, len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        direct = merged = 0
        for piece, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text) if self.normalizer else text):
            if piece in self.whole:
                direct += 1
                continue
            n = self.merged.get(piece)
            if n is None:
                if len(self.merged) >= REMEMBERED:
                    self.merged.clear()
                n = self.merged[piece] = len(self.merge(piece))
            merged += n
        return direct, merged

    def count(self, text: str) -> tuple[int, int]:
        if not self.suffix:
            return self._pre_tokens(text)
        direct = merged = 0
        for cut in _CUT.findall(text):
            found = self.sums.get(cut)
            if found is None:
                if len(self.sums) >= REMEMBERED:
                    self.sums.clear()
                found = self.sums[cut] = self._pre_tokens(cut)
            direct += found[0]
            merged += found[1]
        return direct, merged


def whole_tokens(tokenizer, suffix: str) -> frozenset[str]:
    """Vocabulary strings that, as a pre-token, the merges turn into one token: the string's own."""
    merge, proven = tokenizer.model.tokenize, set()
    for string, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if not string.endswith(suffix):
            continue
        alone = string[: len(string) - len(suffix)]
        if alone and [t.id for t in merge(alone)] == [number]:
            proven.add(alone)
    return frozenset(proven)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, n_direct, n_merged`` of every row.

    ``path`` is a byte-pair vocabulary file of the ``tokenizers`` library that every worker can
    read. No begin, end or added token is counted; strings of added tokens inside a text are,
    as the library does by default.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column(1)]
            direct, merged = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(direct, pa.int64()), pa.array(merged, pa.int64())],
                names=["doc_id", "n_bytes", "n_direct", "n_merged"],
            )

    T.ship(docs.sparkSession)
    text = T.whole("text")
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_direct bigint, n_merged bigint")
    tokens = F.col("n_direct") + F.col("n_merged")
    return counted.select(
        "doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"), "n_direct", "n_merged"
    )
