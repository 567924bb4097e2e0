"""Quality rules whose cutoffs are chosen under a guarantee of few false rejections.

A rule rejects a document when its value (a whole number per mille) lies above a cutoff.
For every stratum, rule and cutoff of a fixed grid, the labelled good documents that the
rule would reject are counted: k of n. A cutoff is certified when the exact binomial test
refutes that its false-rejection rate exceeds ``risk / rules``: P(Bin(n, risk / rules) <= k)
is at most ``delta`` divided by the number of tests (Bonferroni over strata, rules and
cutoffs). With probability 1 - delta every certified cutoff keeps its limit at once, so any
choice among them is allowed: each rule takes the one that rejects most bad documents net of
good ones, the looser in a tie, or none. All rules together then reject at most ``risk`` of
the good documents of a stratum.

Nulls: a null text is an empty one; a null stratum is a stratum of its own; labels with a
null id or quality do not count, and of several labels of one id the lowest does. A document
id that occurs several times counts as often. Without labels nothing is certified, and only
the base rule rejects. Every document counts, whatever its length; other columns stay as
they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sizes import broadcast_if_small
from tidemark.llm import text as T

#: Window of the repetition rule, and the symbols.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
CUTOFFS = (10, 20, 50, 100, 150, 200, 300, 400, 500, 700, 1000, 1500, 2000)
RULES = ("symbols", "exclamations", "upper_case", "repeated_words", "repeated_lines")
RISK, DELTA = 0.05, 0.05
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(word_array: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more in the text.

    Windows compare by 64-bit hash, within one text only.
    """

    def covered(grams: Column) -> Column:
        def walk(sorted_grams: Column) -> Column:
            def same(i: Column, j: Column) -> Column:
                return F.coalesce(F.get(sorted_grams, i)["h"] == F.get(sorted_grams, j)["h"], F.lit(False))

            index = F.sequence(F.lit(0), F.size(sorted_grams) - 1)
            twice = F.filter(index, lambda i: same(i, i - 1) | same(i, i + 1))
            at = F.array_sort(F.transform(twice, lambda i: F.get(sorted_grams, i)["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(
                at,
                start,
                lambda acc, i: F.struct(
                    (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"), (i + WINDOW).alias("end")
                ),
                lambda acc: acc["n"],
            )

        placed = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return T.let(F.sort_array(placed), walk)

    def of_hashes(hashes: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))
        )
        return T.let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(0))

    enough = F.size(word_array) > WINDOW
    hashes = F.transform(word_array, lambda w: F.xxhash64(w))
    return F.when(enough, T.let(hashes, of_hashes)).otherwise(0).cast("bigint")


def _measures(text: Column) -> Column:
    """All counts of a text as one struct."""
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    lines = F.filter(F.split(text, "\n"), has_word)
    return T.let(
        T.words(text),
        lambda w: T.let(
            lines,
            lambda l: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.char_length(F.translate(text, T.SPACES, "")).cast("bigint").alias("word_chars"),
                T.count_chars(text, SYMBOLS).alias("n_symbols"),
                (F.size(l) - F.size(F.array_distinct(l))).cast("bigint").alias("n_dup_lines"),
                repeated_words(w).alias("n_repeat_words"),
                F.size(l).cast("bigint").alias("n_lines"),
                T.count_chars(text, "!").alias("n_exclamations"),
                T.count_chars(text, T.UPPER).alias("n_upper"),
            ),
        ),
    )


def measures(text: str = "text") -> Column:
    return _measures(T.whole(text))


def rule_values(m: Column) -> list[Column]:
    """The rules' values per mille, in the order of RULES."""

    def per_mille(part: str, of: str) -> Column:
        return F.when(m[of] > 0, F.floor(F.lit(1000) * m[part] / m[of])).otherwise(0).cast("bigint")

    return [
        per_mille("n_symbols", "n_words"),
        per_mille("n_exclamations", "n_words"),
        per_mille("n_upper", "word_chars"),
        per_mille("n_repeat_words", "n_words"),
        per_mille("n_dup_lines", "n_lines"),
    ]


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``(doc_id, stratum, m)``: one narrow row per document."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), measures(text).alias("m"))


def _log_gamma(x: Column) -> Column:
    """ln gamma(x) for x >= 1: Stirling's series at x + 8, then back by the recurrence."""
    z = x + 8
    series = (z - 0.5) * F.ln(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z)
    series = series + 1 / (1260 * z * z * z * z * z)
    for i in range(8):
        series = series - F.ln(x + i)
    return series


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact up to rounding; 1 where k is not below the mean.

    Summed from the term of k downwards; terms beyond 10 sqrt(n) + 200 are below rounding.
    """
    k, n = k.cast("double"), n.cast("double")
    odds = (1 - p) / p
    log_first = (
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
        + k * F.ln(F.lit(p)) + (n - k) * F.ln(F.lit(1 - p))
    )
    terms = F.least(k, F.floor(10 * F.sqrt(n)) + 200).cast("int")
    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    factor = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, j: T.let(
            acc["term"] * (k - j + 1) / (n - k + j) * odds,
            lambda t: F.struct(t.alias("term"), (acc["sum"] + t).alias("sum")),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(log_first) * factor)


def _level_counts(rows: DataFrame, labels: DataFrame, cutoffs: tuple[int, ...]) -> DataFrame:
    """``(stratum, level_0, ..., good, bad)``: labelled documents per stratum and levels of all rules.

    The level is how many cutoffs lie below a rule's value: cutoff i rejects when level > i.
    """
    marks = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_q"))
        .filter("_id IS NOT NULL AND _q IS NOT NULL")
        .groupBy("_id")
        .agg((F.min("_q") > 0).alias("_good"))
    )
    marks, _ = broadcast_if_small(marks)
    held = rows.filter(~base_failed(F.col("m"))).join(marks, F.col("doc_id") == F.col("_id"))
    values = [v.alias(f"_v{i}") for i, v in enumerate(rule_values(F.col("m")))]
    below = lambda v: sum((F.col(v) > c).cast("int") for c in cutoffs)
    names = [f"level_{i}" for i in range(len(values))]
    return (
        held.select("stratum", "_good", *values)
        .select("stratum", "_good", *[below(f"_v{i}").alias(name) for i, name in enumerate(names)])
        .groupBy("stratum", *names)
        .agg(F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    )


def thresholds(
    rows: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, cutoffs: tuple[int, ...] = CUTOFFS
) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, good_rejected, bad_rejected)`` of the rules in force.

    ``rows`` comes from :func:`measured`. Documents are counted once per stratum and combination
    of levels, and these counts are written; rules and cutoffs are taken apart from there, so
    that no row is made per document and rule. Every labelled document that passes the base
    rule takes part.
    """
    counts = T.written(_level_counts(rows, labels, cutoffs), rows.sparkSession, "quality-levels")
    levels = [F.struct(F.lit(i).alias("rule"), F.col(f"level_{i}").alias("level")) for i in range(len(RULES))]
    per_level = (
        counts.select("stratum", "good", "bad", F.inline(F.array(*levels)))
        .groupBy("stratum", "rule", "level")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    )
    totals = counts.groupBy("stratum").agg(F.sum("good").alias("n_good"))
    tests = max(1, totals.count()) * len(RULES) * len(cutoffs)
    rejected = (
        per_level.filter("level > 0")
        .select("stratum", "rule", F.explode(F.sequence(F.lit(0), F.col("level") - 1)).alias("at"), "good", "bad")
        .groupBy("stratum", "rule", "at")
        .agg(F.sum("good").alias("good_rejected"), F.sum("bad").alias("bad_rejected"))
        .withColumnRenamed("stratum", "_s")
    )
    tested = rejected.join(totals, F.col("_s").eqNullSafe(F.col("stratum"))).filter(
        (F.col("bad_rejected") > F.col("good_rejected"))
        & (binomial_tail(F.col("good_rejected"), F.col("n_good"), risk / len(RULES)) <= F.lit(delta / tests))
    )
    best = F.max(
        F.struct((F.col("bad_rejected") - F.col("good_rejected")).alias("gain"), "at", "n_good", "good_rejected", "bad_rejected")
    )
    return (
        tested.groupBy("stratum", "rule")
        .agg(best.alias("b"))
        .select(
            "stratum",
            F.element_at(F.array(*[F.lit(r) for r in RULES]), F.col("rule") + 1).alias("rule"),
            F.element_at(F.array(*[F.lit(c) for c in cutoffs]), F.col("b.at") + 1).cast("bigint").alias("cutoff"),
            "b.n_good",
            "b.good_rejected",
            "b.bad_rejected",
        )
    )


def _with_verdict(rows: DataFrame, limits: DataFrame, stratum: str, m: str) -> DataFrame:
    """``rows`` plus ``_rule``: the first rule that rejects a row, null for none."""
    per_stratum = limits.groupBy(F.col("stratum").alias("_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs")
    )
    per_stratum, _ = broadcast_if_small(per_stratum)
    joined = rows.join(per_stratum, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    fails = [
        F.when(value > F.element_at(F.col("_cutoffs"), F.lit(rule)), F.lit(rule))
        for rule, value in zip(RULES, rule_values(F.col(m)))
    ]
    return joined.withColumn("_rule", F.coalesce(*fails)).drop("_stratum", "_cutoffs")


def judge(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """The verdict on every row of :func:`measured`."""
    out = _with_verdict(rows, limits, "stratum", "m")
    failed = base_failed(F.col("m"))
    return out.select(
        "doc_id",
        *[F.col(f"m.{c}") for c in COUNTS],
        failed.alias("base_failed"),
        (~failed & F.col("_rule").isNull()).alias("kept"),
        F.col("_rule").alias("rejected_by"),
    )


def rows_with_measures(docs: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """``(_row, _s, _m)``: whole rows of ``docs`` beside their stratum and measures.

    The measures come out of a generator, which filters are not moved through; else the
    optimiser would repeat them for every condition.
    """
    return docs.select(F.struct("*").alias("_row"), F.col(stratum).alias("_s"), F.explode(F.array(measures(text))).alias("_m"))


def keep_passed(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Those of :func:`rows_with_measures` that pass, with the columns they came with."""
    passed = _with_verdict(rows.filter(~base_failed(F.col("_m"))), limits, "_s", "_m").filter("_rule IS NULL")
    return passed.select("_row.*")


def keep_good(docs: DataFrame, limits: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. Texts are not shuffled."""
    return keep_passed(rows_with_measures(docs, text, stratum), limits)
