"""The training-data operators against SQL, brute force and hand-made edge cases."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from compare import differences
from tidemark.functions.sizes import broadcast_if_small, measured_bytes
from tidemark.llm import text as T
from tidemark.llm import ctw, exact_dedup, jaccard, licences, line_chunks, mixing, packing, preference, risk_rules, urls
from tidemark.llm.oracles import ORACLES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size bigint, t string"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls everywhere, empty and repeated rows, ties, a very long text, clashing columns."""
    long = " ".join(f"w{i % 700}" for i in range(60_000))
    rows = [
        (1, "A b c d e f g", "en", "a"), (1, "A b c d e f g", "en", "a"), (2, "a B c d e f g", None, None), (None, "lone text", "en", "a"),
        (3, None, None, None), (4, "", "de", "b"), (5, " \t\n", "de", "b"), (6, long, "en", "c"), (7, long.upper(), "en", None),
        (8, "x y", None, "b"), (9, "x\ny\n\nx\ny", "fr", "a"),
    ]
    return spark.createDataFrame([(*r, 0, True, 5, "t") for r in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    assert differences(entry_point.queries()[name](spark, sf_dir), ORACLES[name], sf_dir) is None


def test_every_operator_is_registered():
    names = entry_point.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_exact_dedup_edges(spark, edge, nothing):
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(edge, spark).collect()}
    assert {(2, 2, 3, True), (1, 2, 3, False), (None, None, 1, True), (6, 7, 2, False), (3, 4, 2, False)} <= found
    assert exact_dedup.keep_one(edge, spark).count() == 7
    tie = edge.filter("doc_id = 1")
    assert exact_dedup.keep_one(tie, spark).count() == 1
    assert sorted(r.kept for r in exact_dedup.exact_dedup(tie, spark).collect()) == [False, True]
    assert exact_dedup.exact_dedup(nothing, spark).count() == 0


def test_key_collisions_go_through_chains(spark, sf_dir, edge, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(edge.select("doc_id", "text", "lang", "source", "n_chars"))
    expected = sorted(map(str, exact_dedup.exact_dedup(docs, spark).collect()))
    left = sorted(r.doc_id or 0 for r in exact_dedup.keep_one(docs, spark).collect())
    monkeypatch.setattr(exact_dedup, "key_of", lambda norm: F.length(norm) % 7)
    _, owned = exact_dedup.build_index(docs, spark, capacity=20)
    chains = exact_dedup.compared(docs, owned, spark).groupBy("key").agg(F.max("chain").alias("n")).collect()
    assert len(chains) == 7 and min(r.n for r in chains) > 5
    assert sorted(map(str, exact_dedup.exact_dedup(docs, spark, capacity=20).collect())) == expected
    assert sorted(r.doc_id or 0 for r in exact_dedup.keep_one(docs, spark).collect()) == left


def test_owners_compare_within_their_ranges(spark):
    texts = spark.range(1000).selectExpr("CAST(id % 9 AS int) AS bucket", "xxhash64(id % 300) AS key", "CAST(id AS string) AS _norm", "id AS keep_id", "1L AS n")
    plan = exact_dedup.to_owners(texts)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(bucket" in plan and "hashpartitioning" not in plan


def test_directory_splits_full_buckets_only(spark):
    texts = spark.range(4000).selectExpr("xxhash64(id) AS key", "id AS digest")
    depth, entries = exact_dedup.directory(texts, capacity=300)
    assert len(entries) == 2**depth and depth >= 4
    owned = exact_dedup.with_bucket(texts, spark, depth, entries)
    assert owned.count() == 4000 and max(r["count"] for r in owned.groupBy("bucket").count().collect()) <= 300


def test_mixing_edges_and_targets(spark, edge, nothing):
    rows = mixing.sized(edge)
    plan = mixing.plan(rows, rows_per_range=1)
    taken = mixing.taken(rows, plan).collect()
    assert len(taken) == edge.count() and all(0 <= r.taken <= 3 * r.size for r in taken)
    total = sum(r.size for r in taken)
    assert math.isclose(sum({r.source_size: r.target for r in taken}.values()), total, rel_tol=1e-9)
    mixed = mixing.mixed(edge, plan)
    assert mixed.columns == edge.columns
    words = mixing.sized(mixed).groupBy().sum("size").first()[0]
    assert words == sum(r.taken for r in taken)
    assert mixing.taken(mixing.sized(nothing), mixing.plan(mixing.sized(nothing))).count() == 0


def test_risk_rules_guarantee_and_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], LABELS)
    rows = risk_rules.measured(edge)
    verdict = risk_rules.judge(rows, risk_rules.thresholds(rows, labels)).collect()
    assert len(verdict) == edge.count() and all(v.kept == (not v.base_failed) for v in verdict)
    assert risk_rules.keep_good(edge, risk_rules.thresholds(rows, labels)).columns == edge.columns
    assert risk_rules.judge(risk_rules.measured(nothing), risk_rules.thresholds(rows, labels)).count() == 0
    cases = spark.createDataFrame([(k, n) for k, n in ((0, 10), (3, 400), (9, 2000), (40, 5000))], "k long, n long")
    for r in cases.withColumn("p", risk_rules.binomial_tail(cases.k, cases.n, 0.01)).collect():
        exact = sum(math.comb(r.n, j) * 0.01**j * 0.99 ** (r.n - j) for j in range(r.k + 1)) if r.k < r.n * 0.01 else 1
        assert math.isclose(r.p, exact, rel_tol=1e-9)


def test_repeated_words_by_brute_force(spark, edge):
    for r in risk_rules.measured(edge).join(edge.select("doc_id", "text").distinct(), "doc_id").collect():
        words = (r.text or "").split()
        seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        hit = {p for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
        assert r.m.n_repeat_words == len(hit)


def test_urls_edges(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.NET"), (2, None), (None, "http://x.example.net/en/a?q#f"), (3, "no scheme"), (4, "http://net/"), (4, "http://net/")],
        "page_id long, url string",
    )
    rules = urls.rule_table(spark, [("block", "net", "/"), ("allow", "example.net", "/en/"), ("allow", "net", "/")])
    got = sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, rules).collect())
    assert got == [
        (0, "x.example.net", "/en/a", "example.net/en/", "allow"), (1, "a.net", "", None, "allow"), (2, "", "", None, "allow"),
        (3, "", "", None, "allow"), (4, "net", "/", "net/", "block"), (4, "net", "/", "net/", "block"),
    ]
    assert urls.judge(pages, urls.rule_table(spark, [])).filter("verdict = 'allow'").count() == 6


def test_urls_hostile_hosts_and_clashing_names(spark):
    deep = "a." * 5000 + "net"
    pages = spark.createDataFrame([(1, f"x://{deep}/p" + "q" * 100_000, "r", "v", "h")], "page_id long, url string, rule string, verdict string, host string")
    odd = [("block", "net", "/"), ("allow", "o'x.net", "/"), ("allow", "back\\slash.net", "/"), ("allow", "a.net", "/pq")]
    rules = urls.rule_table(spark, odd)
    assert sorted(map(tuple, rules.collect())) == sorted(odd)
    row = urls.judge(pages, rules).first()
    assert (row.host, row.rule, row.verdict) == (deep, "a.net/pq", "allow")
    # As many expressions as rules have shapes, however many labels the host has.
    places = spark.createDataFrame([(deep, "/pq")], "host string, path string")
    assert urls.expressions(places, [1, 3], [1, 2]).count() == 4
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_line_chunks_and_licences_edges(spark, edge, nothing):
    passage = "\n".join(f"line {i} of a passage" for i in range(40))
    docs = spark.createDataFrame([(1, "head\n" + passage), (2, "other head\nmore\n" + passage + "\ntail"), (3, None)], "doc_id long, text string")
    clean = {r.doc_id: r.text for r in line_chunks.line_dedup(docs, spark).collect()}
    assert clean[1] == "head\n" + passage and clean[3] == "" and len(clean[2]) < len(passage) / 2 and clean[2].startswith("other head")
    assert line_chunks.line_dedup(edge, spark).count() == edge.count()
    assert line_chunks.line_dedup(nothing, spark).count() == 0
    mit = "Copyright (c) 2020 Someone\n\n" + licences.KNOWN[0][1].replace("sublicense", "sublicence").upper()
    docs = spark.createDataFrame([(1, mit), (2, "text\nReleased under the MIT Licence!"), (3, None), (None, "")], "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.n_licence_lines) for r in licences.scan(docs, spark).collect()}
    assert got == {1: ("MIT", 0), 2: (None, 1), 3: (None, 0), None: (None, 0)}
    assert licences.scan(nothing, spark).count() == 0
    clash = docs.selectExpr("doc_id", "text", "'x' AS licence", "'y' AS _lines", "'z' AS digest")
    assert sorted(map(str, licences.scan(clash, spark).collect())) == sorted(map(str, licences.scan(docs, spark).collect()))


def test_licence_notices_long_texts_and_given_tables(spark):
    body = "\n".join(f"line {i}" for i in range(100_000))
    docs = spark.createDataFrame(
        [(1, "# SPDX-License-Identifier: GPL-2.0-or-later\n" + body), (2, "licensed under CC BY-SA 4.0\nLicenced under the MIT Licence"), (3, "My Own\nLicence.")],
        "doc_id long, text string",
    )
    got = {r.doc_id: (r.licence, r.n_licence_lines, r.line_licences) for r in licences.scan(docs, spark).collect()}
    assert got == {1: (None, 1, "GPL-2.0"), 2: (None, 2, "CC-BY-SA-4.0,MIT"), 3: (None, 0, "")}
    own = licences.known_digests(spark.createDataFrame([("own", "my own license"), ("none", "\n")], "licence string, text string"))
    got = {r.doc_id: (r.licence, r.n_licence_lines) for r in licences.scan(docs, spark, known=own).collect()}
    assert got == {1: (None, 0), 2: (None, 0), 3: ("own", 0)}
    assert licences.scan(docs, spark, known=own.limit(0)).filter("licence IS NULL").count() == 3


@pytest.mark.parametrize("name, file", [("GPL-3.0", "GPL-3"), ("Apache-2.0", "Apache-2.0"), ("MPL-2.0", "MPL-2.0")])
def test_full_texts_are_known(spark, name, file):
    path = f"/usr/share/common-licenses/{file}"
    if not os.path.exists(path):
        pytest.skip("no licence texts on this machine")
    with open(path) as f:
        docs = spark.createDataFrame([(1, re.sub(r"\blicense\b", "licence", f.read()).upper())], "doc_id long, text string")
    assert licences.scan(docs, spark).first().licence == name


def test_preference_prefix_and_masks(spark):
    turns = [("user", "hi"), ("assistant", "yes"), ("user", "more")]
    rows = [(1, turns + [("assistant", "good")], turns + [("assistant", "bad")]), (2, turns, turns), (3, None, turns[:1]), (4, [], [])]
    pairs = spark.createDataFrame(rows, "id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    got = {r.id: r for r in preference.format_pairs(pairs).collect()}
    assert got[1].n_prompt_turns == 3 and [got[1].chosen[s.start : s.end] for s in got[1].chosen_mask] == ["good<|im_end|>\n"]
    assert got[2].chosen == "" and got[3].n_prompt_turns == 0 and got[3].chosen_mask == [] and got[4].prompt == ""
    odd = spark.createDataFrame([(None, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    assert preference.format_pairs(preference.last_reply_pairs(preference.conversations(odd))).count() == 2
    assert preference.format_pairs(preference.last_reply_pairs(preference.conversations(odd.limit(0)))).count() == 0


def test_turns_without_a_conversation_and_clashing_names(spark):
    schema = "conv_id long, turn long, role string, text string, prompt string, turns string"
    alone = [(None, i % 3, "user", f"t{i % 50}", "x", "y") for i in range(600)]
    long = "word " * 200_000
    turns = spark.createDataFrame(alone + [(7, 1, "assistant", long, "x", "y"), (7, 0, "user", "q", "x", "y")], schema)
    talks = preference.conversations(turns)
    assert talks.filter("conv_id IS NULL AND size(turns) = 1").count() == 150 and talks.count() == 151
    pairs = preference.last_reply_pairs(talks).selectExpr("*", "'p' AS prompt", "'q' AS given_prompt", "'m' AS Chosen_Mask", "'d' AS `a.b`")
    out = preference.format_pairs(pairs)
    assert out.columns == ["conv_id", "given_given_prompt", "given_prompt", "given_Chosen_Mask", "a.b", *preference.RESULTS]
    row = out.filter("conv_id = 7").first()
    assert row.chosen.endswith(long + preference.END) and row.given_given_prompt == "p" and row.given_prompt == "q"


def brute_components(rows):
    sets = {}
    for doc, text in rows:
        w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            x, y = sets[a], sets[b]
            if a < b and x and 100 * len(x & y) >= 80 * len(x | y):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {d: new if r == old else r for d, r in root.items()}
    return {d: (len(sets[d]), root[d]) for d in sets}


@pytest.mark.parametrize("few", [0, 32])
def test_jaccard_by_brute_force(spark, monkeypatch, few):
    """With few = 0 every open n-gram counts as crowded."""
    monkeypatch.setattr(jaccard, "FEW_PAIRS", few)
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(50)]
    rows = [(0, None), (1, ""), (2, "a b"), (3, "A  b"), (4, "a b c")]
    for family in range(8):
        base = [f"f{family}w{i}" for i in range(int(rng.integers(12, 90)))]
        for _ in range(12):
            w = base + (passage if family % 2 else [])
            for i in rng.integers(0, len(w), int(rng.integers(0, 4))):
                w[i] = f"x{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(w)))
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_groups(docs, spark).collect()}
    assert got == brute_components(rows)


def test_jaccard_edges(spark, edge, nothing):
    assert jaccard.near_groups(edge, spark).count() == edge.count()
    assert jaccard.keep_one(edge, spark).columns == edge.columns
    assert jaccard.near_groups(nothing, spark).count() == 0


@pytest.mark.parametrize("limit", [0, jaccard.BROADCAST_BYTES])
def test_components_broadcast_and_shuffled(spark, monkeypatch, limit):
    """A path, a star and a repeated link; minima are broadcast where they are few."""
    monkeypatch.setattr(jaccard, "BROADCAST_BYTES", limit)
    links = [(i, i + 1) for i in range(20)] + [(50 + i, 49) for i in range(1, 9)] + [(51, 49), (7, 7)]
    found = jaccard.components(spark.createDataFrame(links, "a bigint, b bigint"), spark)
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(1, 21)] + [(50 + i, 49) for i in range(1, 9)]


@pytest.mark.parametrize("rows", [0, 7])
def test_measured_tables_need_no_further_job(spark, rows):
    """The driver of a long pipeline pays for every job, so sizes are noted as tables are written."""
    table = T.written(spark.range(rows).withColumn("t", F.lit("é")), spark, "measured", measure=True)
    spark.sparkContext.setJobGroup("measured", "")
    small = broadcast_if_small(table)[1], broadcast_if_small(table, limit=rows - 1)[1]
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("measured")
    spark.sparkContext.setJobGroup("", "")
    assert not jobs and small == (True, False)
    assert table._tidemark_rows == rows and table._tidemark_bytes == measured_bytes(spark.read.parquet(table._tidemark_path))


def brute_ctw(train, text):
    counts = defaultdict(lambda: [0, 0])
    contexts = defaultdict(set)

    def steps(raw):
        padded = b"\0\0\0" + raw
        for i in range(3, len(padded)):
            node = 1
            for j in range(7, -1, -1):
                bit = padded[i] >> j & 1
                yield [(padded[i - d : i], node) for d in range(4)], bit
                node = 2 * node + bit

    for raw in train:
        for path, bit in steps(raw):
            for d, key in enumerate(path):
                counts[key][bit] += 1
                if d:
                    contexts[path[d - 1]].add(key)
    log_kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    logs = {}
    for key in sorted(counts, key=lambda k: -len(k[0])):
        own = log_kt(*counts[key])
        if len(key[0]) == 3:
            logs[key] = (own, None)
        else:
            longer = sum(logs[c][0] for c in contexts[key])
            both = np.logaddexp(own, longer)
            logs[key] = (both - math.log(2), math.exp(own - both))
    total = 0.0
    for path, bit in steps(text):
        p = 0.5
        for key in reversed(path):
            if key in counts:
                own = (counts[key][1] + 0.5) / (sum(counts[key]) + 1)
                w = logs[key][1]
                p = own if w is None else w * own + (1 - w) * p
        total += math.log10(p if bit else 1 - p)
    return total


@pytest.mark.parametrize("limits", [{}, {"words_kept": 3, "table_bytes": 0}])
def test_context_tree_by_brute_force(spark, limits):
    rows = [(i, t) for i, t in enumerate(["the cat sat", "A cat", None, "the the hat é", "unseen zebra", "cat"] * 4)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    low = lambda t: (t or "").lower()
    is_held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    train = [t for i, t in rows if not is_held(i)]
    c = Counter(w for t in train for w in [*low(t).split(), None])
    norm = sum(c.values()) + 0.1 * (len(c) + 1)
    for r in ctw.score(docs, spark, **limits).collect():
        text = low(dict(rows)[r.doc_id])
        tokens = [*text.split(), None]
        assert (r.held_out, r.n_tokens, r.n_known) == (is_held(r.doc_id), len(tokens), sum(c[w] > 0 for w in tokens))
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / norm) for w in tokens), rel_tol=1e-9)
        assert math.isclose(r.score, brute_ctw([low(t).encode() for t in train], text.encode()), rel_tol=1e-5, abs_tol=1e-9)


def test_context_tree_edges(spark, edge, nothing):
    assert ctw.score(edge, spark).filter("score IS NULL OR base_score IS NULL").count() == 0
    assert ctw.score(nothing, spark).count() == 0


def check_packed(rows, texts):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.tokenizer_path()).encode
    ids = {d: encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts.items()}
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(part.tobytes()) == r.ids_crc32
    assert own.keys() == ids.keys()
    for d, pieces in own.items():
        pieces.sort(key=lambda r: r.start)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids[d])
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.length for p in pieces) <= 4096
    return sum(r.length for r in rows) / sum(p[0].padded_length for p in sequences.values())


def test_packing_round_trip(spark, sf_dir, edge, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    full = check_packed(packing.pack(docs, spark).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert full > 0.97
    assert packing.pack(edge, spark).select("doc_id", "doc_tokens").count() >= edge.count()
    assert packing.pack(nothing, spark).count() == 0


def test_short_texts_waste_little(spark):
    docs = spark.createDataFrame([(i, "a b" if i % 3 else "c") for i in range(30_000)], "doc_id long, text string")
    rows = packing.pack(docs, spark).collect()
    assert check_packed(rows, {r.doc_id: r.text for r in docs.collect()}) > 0.95


@pytest.mark.parametrize("window, bins", [(4096, 256), (4096, 4096), (1000, 7), (10, 256), (300, 256)])
def test_bins_and_strategies(window, bins):
    lengths = packing.bin_lengths(window, bins)
    assert lengths[0] == 0 and lengths[-1] == window and (np.diff(lengths) > 0).all()
    if len(lengths) > 1000:
        return
    combos = packing.strategies(lengths)
    assert len(combos) and (lengths[combos].sum(axis=1) == window).all()
    histogram = np.random.default_rng(1).integers(0, 50, len(lengths)) * (np.arange(len(lengths)) > 0)
    layout = packing.plan(histogram, lengths)
    packed = Counter()
    for combo, n in layout:
        assert lengths[list(combo)].sum() <= window
        packed.update({b: n * combo.count(b) for b in set(combo)})
    assert [packed[b] for b in range(len(lengths))] == histogram.tolist()


def test_pipeline_by_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        assert docs.columns == before.columns and docs.count() > 0
        left, rows = {r.doc_id for r in docs.collect()}, before.collect()
        if name == "exact_dedup":
            best = {}
            for r in rows:
                best[r.text.lower()] = max(r.doc_id, best.get(r.text.lower(), -1))
            assert left == set(best.values())
        if name == "near_dedup":
            assert left == {d for d, (_, c) in brute_components([(r.doc_id, r.text) for r in rows]).items() if d == c}
    mixed = corpus_pipeline.mix(spark, docs, sf_dir).cache()
    total = mixing.sized(docs).groupBy().sum("size").first()[0]
    assert abs(mixing.sized(mixed).groupBy().sum("size").first()[0] - total) < 40
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert len(packed) >= mixed.count()
