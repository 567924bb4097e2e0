"""The queries' results as DuckDB SQL over the same tables."""

from __future__ import annotations

from tidemark.llm import dual_tree, licences, line_chunks, mixing, preference, risk_rules
from tidemark.llm.queries import URL_RULES


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def op1() -> str:
    start, end = _q(preference.START), f"'{preference.END.strip()}' || chr(10)"
    head = f"{start} || t.role || chr(10)"
    render = lambda side: f"coalesce(array_to_string(list_transform({side}, lambda t: {head} || t.txt || {end}), ''), '')"
    size = f"len({head} || t.txt || {end})"

    def spans(side: str) -> str:
        before = f"coalesce(list_sum(list_transform({side}[1:i-1], lambda t: {size})), 0)::BIGINT"
        span = f"""({before} + len({start} || {side}[i].role || chr(10)))::VARCHAR || '-' || ({before} + len({start} || {side}[i].role || chr(10) || {side}[i].txt || {end}))::VARCHAR"""
        return f"coalesce(array_to_string(list_transform(list_filter(range(1, len({side}) + 1), lambda i: {side}[i].role = 'assistant'), lambda i: {span}), ','), '')"

    return f"""
WITH rows AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations),
talks AS (
  SELECT conv_id, list({{'role': role, 'txt': txt}} ORDER BY turn NULLS FIRST, role, txt) AS turns FROM rows
  GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN {{'turn': turn, 'role': role, 'txt': txt}} END),
placed AS (
  SELECT *, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant') AS replies FROM talks),
sides AS (
  SELECT conv_id,
    CASE WHEN len(replies) = 0 THEN turns ELSE turns[1:replies[-1]] END AS c,
    CASE WHEN len(replies) = 0 THEN turns ELSE list_concat(turns[1:replies[-1] - 1],
      [{{'role': 'assistant', 'txt': CASE WHEN len(replies) > 1 THEN turns[replies[-2]].txt ELSE '' END}}]) END AS r
  FROM placed),
cut AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1, least(len(c), len(r)))::BIGINT AS n FROM sides),
parts AS (SELECT conv_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM cut)
SELECT conv_id, n AS n_prompt_turns, {render('p')} AS prompt, {render('c')} AS chosen, {spans('c')} AS chosen_mask,
  {render('r')} AS rejected, {spans('r')} AS rejected_mask
FROM parts"""


def op2() -> str:
    rules, cutoffs = risk_rules.RULES, risk_rules.CUTOFFS
    values = ["per(n_symbols, n_words)", "per(n_excl, n_words)", "per(n_upper, word_chars)", "per(n_repeat_words, n_words)", "per(n_dup_lines, n_lines)"]
    for i, v in enumerate(values):
        a, b = v[4:-1].split(", ")
        values[i] = f"CASE WHEN {b} > 0 THEN (1000 * {a}) // {b} ELSE 0 END"
    risk = risk_rules.RISK / len(rules)
    chars = lambda c: f"(len(t) - len(translate(t, {c}, '')))"
    value_rows = " UNION ALL ".join(f"SELECT doc_id, lang, good, {i} AS rule, {v} AS v FROM held" for i, v in enumerate(values))
    first = "coalesce(" + ", ".join(f"CASE WHEN v{i} > (SELECT c FROM chosen k WHERE k.rule = {i} AND k.lang IS NOT DISTINCT FROM f.lang) THEN '{r}' END" for i, r in enumerate(rules)) + ")"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS u, doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
spread AS (SELECT u, unnest(range(1, len(w) - 6)) AS i, w FROM docs WHERE len(w) > 8),
grams AS (SELECT u, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS g FROM spread),
twice AS (SELECT u, i FROM grams QUALIFY count(*) OVER (PARTITION BY u, g) > 1),
covered AS (SELECT u, count(DISTINCT p) AS n FROM (SELECT u, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY u),
m AS (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, len(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    {chars(_q(risk_rules.SYMBOLS))}::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(l) AS n_lines, {chars("'!'")} AS n_excl, {chars("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'")} AS n_upper
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM docs) d LEFT JOIN covered c USING (u)),
f AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  {', '.join(f'{v} AS v{i}' for i, v in enumerate(values))} FROM m),
marks AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT f.*, good FROM f JOIN marks USING (doc_id) WHERE NOT base_failed),
totals AS (SELECT lang, count(*) FILTER (good) AS n FROM held GROUP BY lang),
tests AS (
  SELECT lang, rule, c, count(*) FILTER (good AND v > c) AS k, count(*) FILTER (NOT good AND v > c) AS bad
  FROM ({value_rows}) x, (SELECT unnest({list(cutoffs)}) AS c) g GROUP BY lang, rule, c),
judged AS (
  SELECT t.*, n, CASE WHEN k >= n * {risk!r}::DOUBLE THEN 1.0 ELSE (
    SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({risk!r}::DOUBLE) + (n - j) * ln(1 - {risk!r}::DOUBLE)))
    FROM (SELECT unnest(range(0, k + 1)) AS j) s) END AS p
  FROM tests t JOIN totals o ON t.lang IS NOT DISTINCT FROM o.lang),
chosen AS (
  SELECT lang, rule, max_by(c, (bad - k) * 100000 + c) AS c FROM judged
  WHERE bad > k AND p <= {risk_rules.DELTA!r}::DOUBLE / (greatest((SELECT count(*) FROM totals), 1) * {len(rules) * len(cutoffs)})
  GROUP BY lang, rule),
verdict AS (SELECT *, {first} AS why FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND why IS NULL AS kept, why AS rejected_by
FROM verdict"""


def op3() -> str:
    pairs = ", ".join(f"{_q(a)}: {_q(b)}" for a, b in licences.EQUIVALENT.items())
    lines = (
        f"list_filter(list_transform(list_filter(string_split({_LOWER.format('t')}, chr(10)), lambda l: NOT regexp_matches(l, {_q(licences.COPYRIGHT_LINE)})), "
        f"lambda l: array_to_string(list_transform(string_split(trim(regexp_replace(l, {_q(licences.NOT_A_WORD)}, ' ', 'g')), ' '), "
        f"lambda w: coalesce(MAP {{{pairs}}}[w], w)), ' ')), lambda x: x <> '')"
    )
    known = ", ".join(f"({_q(name)}, {_q(text)})" for name, text in [*licences.KNOWN, *licences.notices()])
    full = ", ".join(f"({_q(name)}, {_q(digest)})" for name, digest in licences.FULL_TEXTS)
    return f"""
WITH known AS (
  SELECT min(licence) AS licence, digest FROM (
    SELECT licence, sha256(coalesce(array_to_string({lines}, ' '), '')) AS digest FROM (VALUES {known}) k(licence, t)
    UNION ALL SELECT * FROM (VALUES {full}) f(licence, digest)) GROUP BY digest),
docs AS (SELECT row_number() OVER () AS u, doc_id, {lines} AS lines FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
hits AS (
  SELECT u, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names
  FROM (SELECT u, sha256(unnest(lines)) AS digest FROM docs) JOIN known USING (digest) GROUP BY u)
SELECT doc_id, sha256(coalesce(array_to_string(lines, ' '), '')) AS canonical_sha256, known.licence AS licence,
  coalesce(n, 0)::BIGINT AS n_licence_lines, coalesce(names, '') AS line_licences
FROM docs LEFT JOIN hits USING (u) LEFT JOIN known ON known.digest = sha256(coalesce(array_to_string(lines, ' '), ''))"""


def op4() -> str:
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM docs),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(r) AS component_id FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id, s"""


def op7() -> str:
    return f"""
WITH sized AS (
  SELECT row_number() OVER () AS u, doc_id, source, len({_WORDS})::BIGINT AS size,
    md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source),
w AS (
  SELECT *, {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1]::BIGINT AS weight,
    {mixing.MOST_EPOCHS} * size AS most FROM s),
lev AS (
  SELECT *, sum(size) OVER () AS total,
    sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS share,
    sum(size) OVER () - coalesce(sum(most) OVER b, 0) AS rest
  FROM w WINDOW b AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lim AS (SELECT *, most * share <= rest * weight AS limited FROM lev),
goal AS (
  SELECT source, size AS source_size, CASE WHEN limited THEN most::DOUBLE ELSE
    ((max(total) OVER () - coalesce(sum(most) FILTER (limited) OVER (), 0))::DOUBLE / (sum(weight) FILTER (NOT limited) OVER ())::DOUBLE) * weight END AS target
  FROM lim),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
    floor(target)::BIGINT - CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END * source_size AS rest FROM goal),
run AS (
  SELECT z.*, c.* EXCLUDE (source), coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY key, doc_id, size, u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized z JOIN cut c ON z.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM run"""


def op8() -> str:
    rules = ", ".join(f"({_q(v)}, {_q(h)}, {_q(p)})" for v, h, p in URL_RULES)
    return f"""
WITH parts AS (
  SELECT row_number() OVER () AS u, page_id, CASE WHEN coalesce(strpos(url, '://'), 0) > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
placed AS (
  SELECT u, page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
best AS (
  SELECT u, max_by({{'verdict': verdict, 'rule': r.host || r.path}}, len(r.host || r.path)) AS b
  FROM placed p JOIN (VALUES {rules}) r(verdict, host, path)
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY u)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM placed LEFT JOIN best USING (u)"""


def op9() -> str:
    return f"""
WITH n AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)"""


def op10() -> str:
    lc, word = line_chunks, r"[^\x20\x09-\x0D]"
    h = lambda i: f"coalesce(h[{i}], 0)"
    value = "0"
    for back in range(lc.WINDOW - 1, -1, -1):
        value = f"(({value} * {lc.BASE} + {h(f'i - {back}') if back else 'h[i]'}) % {lc.MODULUS})"
    value = value.replace("coalesce(h[i - 1], 0)", "(CASE WHEN i > 1 THEN h[i - 1] ELSE 0 END)")
    return f"""
WITH lines AS (SELECT row_number() OVER () AS u, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
hashed AS (SELECT *, list_transform(l, lambda x: ('0x' || substr(md5(x), 1, 7))::BIGINT) AS h FROM lines),
ends AS (SELECT *, list_filter(range(1, len(l) + 1), lambda i: {value} % {lc.AVERAGE} = 0 OR i = len(l)) AS e,
    list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '{word}')) AS w FROM hashed),
spans AS (
  SELECT u, doc_id, l, unnest(list_distinct(list_concat(
    list_filter(list_transform(range(1, len(e) + 1), lambda j: {{'a': CASE WHEN j > 1 THEN e[j - 1] + 1 ELSE 1 END, 'b': e[j]}}), lambda s: s.b > s.a),
    list_transform(range(1, len(w)), lambda j: {{'a': w[j], 'b': w[j + 1]}})))) AS s FROM ends),
piece AS (
  SELECT * FROM (SELECT u, doc_id, s.a AS a, s.b AS b, array_to_string(l[s.a:s.b], chr(10)) AS body FROM spans)
  WHERE doc_id IS NOT NULL AND regexp_matches(body, '{word}')),
many AS (SELECT body, min({{'d': doc_id, 'a': a, 'b': b}}) AS first FROM piece GROUP BY body HAVING count(*) > 1),
gone AS (
  SELECT u, list(DISTINCT i) AS g FROM (
    SELECT u, unnest(range(CASE WHEN first.d = doc_id AND first.b >= a THEN first.b + 1 ELSE a END, b + 1)) AS i
    FROM piece JOIN many USING (body) WHERE doc_id <> first.d OR a <> first.a) GROUP BY u),
rest AS (
  SELECT doc_id, l, e, list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(coalesce(g, []), i)) AS r FROM ends LEFT JOIN gone USING (u)),
clean AS (
  SELECT doc_id, len(e) AS n_chunks, len(l) - len(r) AS removed_lines,
    len(e) - len(list_distinct(list_transform(r, lambda i: len(list_filter(e, lambda x: x < i))))) AS removed_chunks,
    array_to_string(list_transform(r, lambda i: l[i]), chr(10)) AS t FROM rest)
SELECT doc_id, n_chunks, removed_chunks, removed_lines, len(t)::BIGINT AS clean_chars, sha256(t) AS clean_sha256 FROM clean"""


def op11() -> str:
    terms = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_q(dual_tree.TERM)})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, {terms} AS ts FROM documents),
corpus AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
items AS (SELECT row_number() OVER () AS i, item_id, list_distinct({terms}) AS ts FROM benchmark),
asked AS (SELECT i, unnest(ts) AS t FROM items),
tf AS (
  SELECT u, doc_id, n, t, count(*) AS tf FROM (SELECT u, doc_id, len(ts) AS n, unnest(ts) AS t FROM d)
  WHERE t IN (SELECT t FROM asked) GROUP BY u, doc_id, n, t),
weight AS (
  SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY t),
coordinate AS (
  SELECT u, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))) AS c
  FROM tf JOIN weight USING (t), corpus),
scores AS (SELECT i, u, doc_id, sum(c)::BIGINT AS score FROM asked JOIN coordinate USING (t) GROUP BY i, u, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS r FROM scores WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (i) WHERE r <= {dual_tree.TOP}"""


def op12() -> str:
    add = lambda x, cost, edit, line="NULL": (
        f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{edit}', 'o': CASE WHEN {line} IS NULL THEN {x}.o ELSE {x}.o || CASE WHEN {x}.o = '' THEN '' ELSE chr(10) END || {line} END}}"
    )
    least = lambda *of: f"list_sort([{', '.join(of)}])[1]"
    # A state is what the row initials spell so far: e nothing, s a system turn, u and a the last turn.
    inserted = [add(x, 5, "I", "'user:'") for x in ("e", "s", "a")]
    edits = {
        "K": lambda x, initial: add(x, f"CASE WHEN fault NOT IN (1, 2) AND initial = '{initial}' THEN late ELSE 1000000000 END", "K", "role || ':' || txt"),
        "R": lambda x, role: add(x, "CASE WHEN fault NOT IN (1, 2) THEN 1 + late ELSE 1000000000 END", "R", f"'{role}:' || txt"),
    }
    gone = lambda x: add(x, 2, "D")
    dead = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"
    return f"""
WITH RECURSIVE
bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS draw
  FROM conversations, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS txt,
    unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn WHERE draw <> 0),
marked AS (
  SELECT *, sha256(txt) AS digest, rtrim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY turn NULLS FIRST) AS nth
  FROM damaged),
rows AS (
  SELECT conv_id, turn, role, txt, left(role, 1) AS initial,
    CASE WHEN bare = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest, nth) AS i
  FROM marked),
parse(conv_id, i, e, s, u, a) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': '', 'o': ''}}, {dead}, {dead}, {dead} FROM conversations
  UNION ALL
  SELECT conv_id, i, {gone("e")}, {least(gone("s"), edits["K"]("e", "s"))},
    {least(gone("u"), *(edits["K"](x, "u") for x in "esa"), *(edits["R"](x, "user") for x in "esa"))},
    {least(gone("a"), edits["K"]("u", "a"), edits["R"]("u", "assistant"))}
  FROM (
    SELECT conv_id, i, e, s, u, {least("a", add("u", 5, "I", "'assistant:'"))} AS a, role, txt, initial, fault, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS late
    FROM (
      SELECT p.conv_id, r.i, e, s, {least("u", *inserted)} AS u, a, role, txt, initial, fault
      FROM parse p JOIN rows r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1))),
ended AS (
  SELECT conv_id, {least("e", "a", add("u", 5, "I", "'assistant:'"))} AS best
  FROM (SELECT conv_id, i, e, a, {least("u", *inserted)} AS u, max(i) OVER (PARTITION BY conv_id) AS n FROM parse) WHERE i = n),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM rows) GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(best.o) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLES = {
    "op1_preference_format": op1(),
    "op2_risk_controlled_rules": op2(),
    "op3_licence_digests": op3(),
    "op4_ngram_jaccard": op4(),
    "op7_mix_sources": op7(),
    "op8_url_rules": op8(),
    "op9_exact_dedup": op9(),
    "op10_line_chunks": op10(),
    "op11_dual_tree_search": op11(),
    "op12_turn_repair": op12(),
}
