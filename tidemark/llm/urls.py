"""Block and allow lists over URLs by hashed host-suffix and path-prefix expressions.

Each URL is expanded into the suffixes of its host, in the numbers of labels that rule hosts have,
joined with the prefixes of its path, in the lengths that rule paths have, so a long host costs no
more than a short one. An expression meets the rules by the first
four bytes of its SHA-256 in an equi-join; the full digest confirms the hit. Of all rules
that fit, the longest decides; of equally long ones that with the longer host, then a block.
URLs that no rule fits get the default verdict.

Nulls: a null URL, or one without ``://``, has an empty host and path. A rule path is a plain
prefix of the URL's path, which keeps its case. Pages that share host and path are judged
once, so a hot URL moves as one row. Without rules every page gets the default, without pages
there is no row. Other columns stay behind, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import text as T

SHORT = 8  # hex digits of the short prefix
RULE_SCHEMA = "verdict string, host string, path string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (
        T.lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    )


def hashed_rules(rules: DataFrame) -> DataFrame:
    """``rules`` of RULE_SCHEMA with their digests; equal rules become one, a block wins."""
    text = F.concat("host", "path")
    return (
        rules.filter("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            text.alias("rule"), F.length("host").alias("host_length"), "verdict",
            F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("_rule_digest"),
        )
        .withColumn("_rule_short", F.substring("_rule_digest", 1, SHORT))
    )


def n_labels(host: str) -> Column:
    return F.size(F.split(host, r"\."))


def expressions(places: DataFrame, lengths: Sequence[int], label_counts: Sequence[int]) -> DataFrame:
    """``(host, path, digest, short)``: the expressions of distinct (host, path)."""
    counts = F.filter(F.array(*[F.lit(n) for n in label_counts]), lambda n: n <= n_labels("host"))
    suffixes = F.transform(counts, lambda n: F.array_join(F.slice(F.split("host", r"\."), -n, n), "."))
    known = F.array(*[F.lit(n) for n in lengths])
    prefixes = F.transform(F.filter(known, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    return (
        places.select("host", "path", F.explode(suffixes).alias("_host"), prefixes.alias("_paths"))
        .select("host", "path", "_host", F.explode("_paths").alias("_path"))
        .select("host", "path", F.sha2(F.concat_ws("\n", "_host", "_path"), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per page."""
    host, path = host_and_path(F.col(url))
    placed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    # Path lengths and label counts of rules are few: an URL's length bounds them.
    shapes = rules.filter("host IS NOT NULL AND path IS NOT NULL").agg(
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"), F.sort_array(F.collect_set(n_labels("host"))).alias("labels")
    ).first()
    if not shapes["lengths"]:
        return placed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    listed = hashed_rules(rules)
    spread = expressions(placed.select("host", "path").distinct(), shapes["lengths"], shapes["labels"])
    hits = spread.join(listed, F.col("short") == F.col("_rule_short")).filter("digest = _rule_digest")
    best = hits.groupBy(F.col("host").alias("_host"), F.col("path").alias("_path")).agg(
        F.max(F.struct(F.length("rule").alias("n"), "host_length", "verdict", "rule")).alias("_best")
    )
    joined = placed.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return joined.select(
        "page_id", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(verdict, host, path)`` triples as a table."""
    if not rules:
        return spark.createDataFrame([], RULE_SCHEMA)
    # Named markers: positional ones lose their order in a VALUES list of several rows.
    values = {f"p{i}": v for i, v in enumerate(v for rule in rules for v in rule)}
    rows = ", ".join(f"(:p{i}, :p{i + 1}, :p{i + 2})" for i in range(0, len(values), 3))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(verdict, host, path)", args=values)
