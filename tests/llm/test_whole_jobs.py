"""Cases of which an operator once did less than the whole."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql.functions import udf

import __spark_entry__ as entry_point
from compare import oracle_rows
from tidemark.llm import ctw, line_chunks, risk_rules
from tidemark.llm.oracles import ORACLES

WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute_line_pairs(rows):
    """Lines that go per document: pairs of neighbouring worded lines that stand earlier."""
    first, docs = {}, []
    for doc, text in rows:
        lines = (text or "").split("\n")
        worded = [i for i, x in enumerate(lines) if WORD.search(x)]
        pairs = [(a, b, "\n".join(lines[a : b + 1])) for a, b in zip(worded, worded[1:])]
        docs.append((doc, lines, pairs))
        for a, b, body in pairs:
            first[body] = min(first.get(body, (doc, a, b)), (doc, a, b))
    gone = {}
    for doc, _, pairs in docs:
        gone[doc] = set()
        for a, b, body in pairs:
            d, start, stop = first[body]
            if (d, start) != (doc, a):
                gone[doc] |= set(range(stop + 1 if d == doc and stop >= a else a, b + 1))
    return {doc: (len(gone[doc]), "\n".join(x for i, x in enumerate(lines) if i not in gone[doc])) for doc, lines, _ in docs}


def test_short_passages_go_whole(spark):
    """Passages of 2 to 6 lines and over 50 words, blank lines within, each in two documents."""
    rows, own = [], {}
    for k in range(100):
        lines = [" ".join(f"p{k}l{i}w{w}" for w in range(30)) for i in range(2 + k % 5)]
        passage = ("\n\n" if k % 3 == 0 else "\n").join(lines)
        rows += [(k, f"head {k}\n{passage}\ntail {k}"), (1000 + k, f"other {k}\nmore {k}\n{passage}\nend {k}")]
        own[1000 + k] = f"other {k}\nmore {k}\nend {k}"
    # Equal lines: what overlaps the first pair goes only past it. One id with two texts: a line goes by its own text.
    rows += [(2000, "z z\nz z\nz z\nz z"), (2001, "head 1\n" + rows[2][1].split("\n")[1]), (2001, "only here\nand here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in line_chunks.line_dedup(docs, spark).collect()]
    clean = dict(got)
    assert all(clean[k] == text for k, text in rows[:200:2])
    assert {k: clean[k] for k in own} == own
    assert clean[2000] == "z z\nz z"
    assert Counter(text for doc, text in got if doc == 2001) == Counter({"": 1, "only here\nand here": 1})


def test_line_chunks_by_brute_force(spark, sf_dir):
    """All repeated pairs go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_line_pairs([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.text for r in line_chunks.line_dedup(docs, spark).collect()}
    assert got == {doc: text for doc, (_, text) in want.items()}
    lines = {r.doc_id: r.removed_lines for r in entry_point.queries()["op10_line_chunks"](spark, sf_dir).collect()}
    assert lines == {doc: n for doc, (n, _) in want.items()}
    names, rows = oracle_rows(ORACLES["op10_line_chunks"], sf_dir)
    doc, n = names.index("doc_id"), names.index("removed_lines")
    assert all(r[n] == lines[r[doc]] for r in rows)


def test_bodies_beyond_the_broadcast(spark, sf_dir, monkeypatch):
    """Lists too large to broadcast: places go to the documents, with the same result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted((r.doc_id, r.text) for r in line_chunks.line_dedup(docs, spark).collect())
    monkeypatch.setattr(line_chunks, "broadcast_if_small", lambda df: (df, False))
    assert sorted((r.doc_id, r.text) for r in line_chunks.line_dedup(docs, spark).collect()) == want


def brute_ctw(train, text, depth):
    """log10 probability of a text after training, by dictionaries of contexts and nodes."""
    counts, contexts = defaultdict(lambda: [0, 0]), defaultdict(set)

    def steps(raw):
        padded = bytes(depth) + raw
        for i in range(depth, len(padded)):
            node = 1
            for j in range(7, -1, -1):
                bit = padded[i] >> j & 1
                yield [(padded[i - d : i], node) for d in range(depth + 1)], bit
                node = 2 * node + bit

    for raw in train:
        for path, bit in steps(raw):
            for shorter, key in zip([None, *path], path):
                counts[key][bit] += 1
                contexts[shorter].add(key)
    log_kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    weighted, weight = {}, {}
    for key in sorted(counts, key=lambda k: -len(k[0])):
        own = log_kt(*counts[key])
        both = own + math.log(2) if len(key[0]) == depth else np.logaddexp(own, sum(weighted[c] for c in contexts[key]))
        weighted[key], weight[key] = both - math.log(2), 1 if len(key[0]) == depth else math.exp(own - both)
    total = 0.0
    for path, bit in steps(text):
        p = 0.5
        for key in reversed(path):
            if key in counts:
                p = weight[key] * (counts[key][1] + 0.5) / (sum(counts[key]) + 1) + (1 - weight[key]) * p
        total += math.log10(p if bit else 1 - p)
    return total


@pytest.mark.parametrize("depth, limits", [(6, {}), (6, {"table_bytes": 0, "group_grams": 1}), (7, {"group_grams": 20})])
def test_long_contexts_by_brute_force(spark, depth, limits):
    rows = [(i, t) for i, t in enumerate(["A cathedral stood", "the cathedral stands", None, "Hé hé thé thé", "unseen zebra", "cathedrals"] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    low = lambda t: (t or "").lower().encode()
    train = [low(t) for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    want = {t: brute_ctw(train, low(t), depth) for _, t in rows}
    got = ctw.score(docs, spark, depth=depth, **limits).collect()
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r.score, want[dict(rows)[r.doc_id]], rel_tol=1e-5, abs_tol=1e-9)


def test_query_gathers_long_contexts(spark, sf_dir):
    """The registered query codes held-out text shorter than contexts of three bytes can."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bits = lambda df: -sum(r.score for r in df.filter("held_out").collect())
    assert bits(entry_point.queries()["op5_context_tree"](spark, sf_dir)) < bits(ctw.score(docs, spark))


def test_labelled_documents_are_counted_once(spark):
    """The limits read each measured row once, and no rows are made per document and rule."""
    seen = spark.sparkContext.accumulator(0)

    def count(lang):
        seen.add(1)
        return lang

    rows = [(i, "en" if i % 2 else None, " ".join(f"w{i}x{k}" for k in range(30)) + " #!" * (i % 3 * 4)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(240)], "doc_id long, quality double")
    lang = udf(count, "string").asNondeterministic()
    measured = risk_rules.measured(docs).withColumn("stratum", lang("stratum"))
    got = risk_rules.thresholds(measured, labels, risk=1.0).collect()
    assert {(r.stratum, r.rule) for r in got} == {(s, rule) for s in ("en", None) for rule in ("symbols", "exclamations")}
    assert {(r.n_good, r.good_rejected, r.bad_rejected) for r in got} == {(40, 0, 80)}
    assert seen.value == len(rows)
