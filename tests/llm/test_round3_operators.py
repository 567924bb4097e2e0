"""Ranked search, conversation repair and token counts against brute force and edge cases."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import dual_tree, jaccard, packing, token_counts, turn_repair

DOCS = "doc_id bigint, text string, n bigint, terms string, score double, rank int, n_bytes int"
TURNS = "conv_id bigint, turn bigint, role string, text string, audit string, digest string, here string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x", 0.5, 1, 3) for i, t in rows], DOCS)


# -- ranked search ------------------------------------------------------------------------


def brute_search(docs, items, k=10):
    term = dual_tree._FIND.findall
    low = lambda t: (t or "").translate(dual_tree._LOWER)
    counts = [(i, Counter(term(low(t)))) for i, t in docs]
    held = [c for _, c in counts if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for c in held)
    df = Counter(t for c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(1, n_terms)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(term(low(text))) if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def random_texts(n, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    return [" ".join(draw.choices(vocabulary, weights=[1 / (i + 1) for i in range(120)], k=draw.randint(0, 60))) for _ in range(n)]


def test_search_equals_brute_force(spark, monkeypatch):
    texts = random_texts(700, 5)
    docs = [(i, t) for i, t in enumerate(texts)] + [(700 + i, texts[3]) for i in range(300)]
    items = [(i, t) for i, t in enumerate(random_texts(60, 6))]
    frames = docs_of(spark, docs).repartition(3), spark.createDataFrame(items, "item_id bigint, text string")
    assert found(dual_tree.search(*frames, spark)) == brute_search(docs, items)
    # Blocks of items and another depth of the list change nothing else.
    assert found(dual_tree.search(*frames, spark, k=3, block_bytes=9000)) == brute_search(docs, items, 3)


def test_search_prunes_whole_batches():
    draw = np.random.default_rng(3)
    weights = draw.integers(1, 9000, 400)
    items = dual_tree.ItemTree(list(range(50)), [sorted(draw.choice(400, 8, replace=False)) for _ in range(50)], weights)
    assert [len(level) for level in items.levels] == [50, 7, 1]
    terms = [np.sort(draw.choice(400, 10, replace=False)) for _ in range(3000)]
    tfs = [draw.integers(1, 5, 10) for _ in terms]
    docs = dual_tree.DocTree(np.full(3000, 10), terms, tfs, (3000, 30000), weights)
    assert [len(level) for level in docs.levels] == [3000, 188, 24, 3, 1]
    for height in range(1, len(docs.levels)):
        for node, most in enumerate(docs.levels[height]):
            assert (docs.levels[height - 1][docs.below(height, np.array([node]))].max(axis=0) == most).all()
    ids = list(range(3000))
    seeds = dual_tree.Search(items, 10)
    seeds.seed(docs, ids)
    floor = np.array([-b[-1][0] if len(b) == 10 else 0 for b in seeds.best], dtype=float)
    search = dual_tree.Search(items, 10, floor)
    search.run(docs, ids)
    assert search.scored < 50 * 3000
    for item, (_, _, held, w) in enumerate(items.levels[0]):
        scores = docs.levels[0][:, held].astype(np.int64) @ w.astype(np.int64)
        best = sorted((-int(s), int(d)) for s, d in zip(scores, docs.order) if s > 0)[:10]
        assert [(s, d) for s, _, d in search.best[item]] == best


def test_search_edges(spark):
    long = " ".join(f"x{i}" for i in range(50_000))
    docs = [(1, "Ab-c ab"), (1, "Ab-c ab"), (None, "ab c"), (2, None), (3, ""), (4, "..."), (5, long + " c"), (6, "Zoë ZOË zoë"), (7, "ab")]
    items = [(1, "AB c"), (1, "zoë"), (None, "c"), (2, None), (3, ""), (4, "nowhere"), (5, "x49999 x7")]
    frames = docs_of(spark, docs), spark.createDataFrame([(*i, "d") for i in items], "item_id bigint, text string, doc_id string")
    assert found(dual_tree.search(*frames, spark)) == brute_search(docs, items)
    nothing = docs_of(spark, [])
    assert dual_tree.search(nothing, frames[1], spark).count() == 0
    assert dual_tree.search(frames[0], frames[1].limit(0), spark).count() == 0
    assert dual_tree.search(docs_of(spark, [(1, None)]), frames[1], spark).count() == 0


# -- conversation repair -------------------------------------------------------------------


def brute_repair(rows):
    """Cheapest ``(cost, audit)`` and its turns by trying everything; rows are (role, text, fault)."""
    step = {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    name = {"u": "user", "a": "assistant"}
    best = {"e": {(0, "", ())}}
    for role, text, fault in [*rows, (None, None, None)]:
        wide = {s: set(v) for s, v in best.items()}
        for _ in range(2):
            for s, v in [(s, set(v)) for s, v in wide.items()]:
                for t in "ua":
                    if (s, t) in step:
                        wide.setdefault(step[s, t], set()).update((c + 5, a + "I", o + (f"{name[t]}:",)) for c, a, o in v)
        if role is None:
            return min((c, a, o) for s in "ea" for c, a, o in wide.get(s, ()))
        after = {}
        for s, v in wide.items():
            after.setdefault(s, set()).update((c + 2, a + "D", o) for c, a, o in v)
            if fault in (1, 2):
                continue
            late = 5 if fault == 3 else 0
            if (s, role[:1]) in step:
                after.setdefault(step[s, role[:1]], set()).update((c + late, a + "K", o + (f"{role}:{text}",)) for c, a, o in v)
            for t in "ua":
                if (s, t) in step:
                    after.setdefault(step[s, t], set()).update((c + 1 + late, a + "R", o + (f"{name[t]}:{text}",)) for c, a, o in v)
        best = after


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        out.append((role, text, 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0))
        seen.add((role, text))
    return out


def test_parser_equals_brute_force_on_all_short_conversations():
    texts = [("system", 0), ("user", 0), ("assistant", 0), ("user", 3), ("tool", 0), ("user", 2)]
    for n in range(5):
        for rows in itertools.product(texts, repeat=n):
            repair = turn_repair.Repair()
            for role, fault in rows:
                repair.row(role[:1], fault)
            cost, audit, roles = repair.finish()
            want = brute_repair([(r, "t", f) for r, f in rows])
            assert (cost, audit) == want[:2], rows
            kept = [r for r in roles if r != "-"]
            assert [line[0] for line in want[2]] == kept and len(roles) == len(audit)


def test_grammar_tables():
    stacks = turn_repair._stacks()
    for word, right in {"": True, "s": False, "su": False, "sua": True, "uaua": True, "uaa": False, "au": False, "uas": False}.items():
        tops = [0]
        for c in word:
            tops = [n for t in tops for n in stacks.steps[t].get(c, ())]
        assert any(stacks.accepts[t] for t in tops) == right, word
    with pytest.raises(ValueError, match="unbounded"):
        turn_repair.Stacks((("C", "uCa"), ("C", "ua")))


def test_repair_of_random_conversations(spark):
    draw = random.Random(11)
    roles, texts = ["user", "assistant", "system", "tool", None, ""], ["Yes.", "No!", "and then", "", " \t", None, "Why?", "No! "]
    rows = [(c, t, draw.choice(roles[: 3 if c % 2 else 6]), draw.choice(texts)) for c in range(60) for t in range(draw.randint(1, 7))]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    plans = turn_repair.plan(table)
    got = {r.conv_id: r for r in plans.collect()}
    lines = {}
    for r in turn_repair.repaired(table, plans).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    hashes = {r.conv_id: r.sha256 for r in turn_repair.digests(turn_repair.repaired(table, plans)).collect()}
    for conv in range(60):
        marked = faults_of([(" " if r is None else r, " " if t is None else t) for c, _, r, t in rows if c == conv])
        cost, audit, turns = brute_repair(marked)
        assert (got[conv].cost, got[conv].audit, lines.get(conv, [])) == (cost, audit, list(turns))
        assert [got[conv].blank, got[conv].duplicate, got[conv].truncated] == [sum(f == k for *_, f in marked) for k in (1, 2, 3)]
        initials = [r[:1] for r, *_ in marked]
        assert got[conv].illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        assert hashes.get(conv) == (hashlib.sha256("\n".join(turns).encode()).hexdigest() if turns else None)


def test_repair_edges(spark):
    rows = [(1, None, "user", "Hm."), (1, None, "user", "Hm."), (1, 9, "assistant", "So."), (1, 4, "user", "x" * 3_000_000 + "."), (None, 1, None, None), (None, 3, "system", "S."), (2, None, "user", "?")]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    got = {r.conv_id: r for r in turn_repair.plan(table).collect()}
    # Nulls first: user Hm., its repetition, user x..., assistant.
    assert (got[1].audit, got[1].cost, got[1].gaps, got[1].duplicate, got[1].illegal) == ("DDKK", 4, 4, 1, 2)
    assert (got[None].audit, got[None].gaps, got[None].blank) == ("DD", 1, 1)
    assert (got[2].audit, got[2].cost, got[2].gaps) == ("D", 2, 0)
    assert turn_repair.plan(table.limit(0)).count() == 0
    assert turn_repair.repair_digest(turn_repair.damaged(table.limit(0)), spark).count() == 0


def test_damage_keeps_every_conversation(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.") for c in range(300) for t in range(2)] + [(None, None, None, None)]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    got = {r.conv_id: r for r in turn_repair.repair_digest(turn_repair.damaged(table), spark).collect()}
    assert set(got) == {*range(300), None}
    draw = lambda c, t: zlib.crc32(f"{c}:{t}".encode()) % 20
    lost = [c for c in range(300) if draw(c, 0) == 0 and draw(c, 1) == 0]
    for c in range(300):
        left = []
        for t, role in ((0, "user"), (1, "assistant")):
            d = draw(c, t)
            row = ("user" if d == 4 else role, "" if d == 1 else f"Text {t}" if d == 2 else f"Text {t}.")
            left += [] if d == 0 else [row, row] if d == 3 else [row]
        cost, audit, turns = brute_repair(faults_of(left))
        assert (got[c].cost, got[c].audit, got[c].repaired_sha256) == (cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())
    assert all(got[c].audit == "" and got[c].gaps == 0 for c in lost)


def test_long_conversation_in_bounded_memory():
    repair = turn_repair.Repair()
    for i in range(20_000):
        repair.row("ua"[i % 2], 3 if i % 997 == 0 else 0)
    cost, audit, _ = repair.finish()
    assert len(audit) >= 20_000 and cost <= 5 * 21 and len(repair.trail) == 20_000 * repair.width


# -- token counts ---------------------------------------------------------------------------


def byte_level_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [packing.tokenizer_path, byte_level_path])
def test_counts_equal_the_library(spark, sf_dir, path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path())
    odd = [
        None, "", " \t\n", "a<|endoftext|>b", "<|startoftext|><|startoftext|>", "<|EndOfText|>", "it's we'll I'M 's't", "Ⅷ½ 12345",
        "ΣΑΣ İstanbul ﬁ", "é ́x a b c\x1cd", "x" * 200_000, "日本語 한국어 \U0001f600\U0001f468‍\U0001f469", "a\x00b", "word " * 30_000,
    ]
    texts = odd + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = token_counts.count_tokens(docs_of(spark, list(enumerate(texts))), path()).collect()
    for r in got:
        text = texts[r.doc_id] or ""
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len(text.encode()), want > 2048), text[:50]
        assert r.n_direct + r.n_merged == r.n_tokens
    assert sum(r.n_direct for r in got) > 1000


def test_proven_strings_and_edges(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.tokenizer_path())
    proven = token_counts.whole_tokens(library, "</w>")
    assert {"the", "of"} <= proven and all(len(library.model.tokenize(w)) == 1 for w in list(proven)[:3000])
    vocabulary = {t[:-4] for t in library.get_vocab(with_added_tokens=False) if t.endswith("</w>")}
    assert proven <= vocabulary
    docs = docs_of(spark, [(1, "a b"), (1, "a b"), (None, "c")])
    out = token_counts.count_tokens(docs, packing.tokenizer_path(), limit=1)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_direct", "n_merged"]
    assert sorted((r.doc_id or 0, r.n_tokens, r.over_limit) for r in out.collect()) == [(0, 1, False), (1, 2, True), (1, 2, True)]
    assert token_counts.count_tokens(docs_of(spark, []), packing.tokenizer_path()).count() == 0


# -- near copies in rounds -------------------------------------------------------------------


def family(n, seed, edits):
    """Copies of one text with words changed at random places, and the text itself."""
    draw = random.Random(seed)
    base = [f"b{seed}w{i}" for i in range(120)]
    out = [" ".join(base)]
    for k in range(n - 1):
        words = list(base)
        for i in draw.sample(range(120), edits[k % len(edits)]):
            words[i] = f"x{seed}k{k}i{i}"
        out.append(" ".join(words))
    return out


def jaccard_components(rows):
    """Components by union of all linked pairs, smallest id that is not null; rows are (id, text)."""
    def grams(text):
        w = (text or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j, k in Counter(j for g in s for j in where[g] if j > i).items():
            if find(i) != find(j) and 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                root[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) if sets[i] else doc for i, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize("few", [0, 32])
def test_families_of_thousands_are_linear(spark, monkeypatch, few):
    """Near copies by the thousand that share a passage with outsiders; rounds give all links, few pairs."""
    monkeypatch.setattr(jaccard, "FEW_PAIRS", few)
    texts = family(2500, 1, (1, 2)) + family(400, 2, (2, 3, 4, 9)) + family(30, 3, (0,))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"o{k}w{i}" for i in range(12 + k % 50)) for k in range(200)]
    order = random.Random(3).sample(range(len(texts)), len(texts))
    rows = [(i, texts[j]) for i, j in enumerate(order)]
    tried = []
    verify = jaccard._Nodes.verify
    monkeypatch.setattr(jaccard._Nodes, "verify", lambda self, pairs, cut: tried.append(verify(self, pairs, cut)) or tried[-1])
    got = {r.doc_id: r.component_id for r in jaccard.near_groups(docs_of(spark, rows), spark).collect()}
    assert got == {d: c for (d, _), c in zip(rows, jaccard_components(rows))}
    assert sum(n for n, _ in tried) < 30 * len(rows)


def test_rows_that_share_an_id_or_have_none(spark):
    a, b, c = family(3, 7, (1,)), family(3, 8, (1,)), family(3, 9, (1,))
    rows = [(5, a[0]), (5, b[0]), (3, a[1]), (9, b[1]), (None, a[2]), (None, c[0]), (None, c[1]), (4, c[2]), (4, c[2]), (6, None), (6, ""), (None, None), (5, "x y z"), (2, "X Y Z")]
    docs = docs_of(spark, rows)
    got = Counter((r.doc_id, r.component_id) for r in jaccard.near_groups(docs, spark).collect())
    assert got == Counter(zip((d for d, _ in rows), jaccard_components(rows)))
    kept = Counter((r.doc_id, r.text) for r in jaccard.keep_one(docs, spark).collect())
    assert kept == Counter([(3, a[1]), (5, b[0]), (4, c[2]), (2, "X Y Z"), (6, None), (6, ""), (None, None)])
    nameless = docs_of(spark, [(None, c[0]), (None, c[1]), (None, "other words than these here")])
    assert jaccard.keep_one(nameless, spark).count() == 2
    assert [r.component_id for r in jaccard.near_groups(nameless, spark).collect()] == [None] * 3
