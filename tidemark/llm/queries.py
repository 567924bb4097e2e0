"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    ctw, dual_tree, exact_dedup, jaccard, licences, line_chunks, mixing, packing, preference, risk_rules, token_counts, turn_repair, urls,
)
from tidemark.llm import text as T
from tidemark.session import prepare

#: Fixed values of the URL contract.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = preference.conversations(_table(spark, sf_dir, "conversations"))
    out = preference.format_pairs(preference.last_reply_pairs(talks))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select(
        "conv_id", "n_prompt_turns", "prompt", "chosen", spans("chosen_mask").alias("chosen_mask"),
        "rejected", spans("rejected_mask").alias("rejected_mask"),
    )


def op2_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.written(risk_rules.measured(_table(spark, sf_dir, "documents")), spark, "quality-measures")
    return risk_rules.judge(rows, risk_rules.thresholds(rows, _table(spark, sf_dir, "labels")))


def op3_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"), spark)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(_table(spark, sf_dir, "documents"), spark)


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(_table(spark, sf_dir, "documents"), spark, depth=ctw.DEPTH)


def op6_pack_least_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), spark)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.written(mixing.sized(_table(spark, sf_dir, "documents")), spark, "mix-sizes")
    return mixing.taken(rows, mixing.plan(rows))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), spark)


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = T.written(line_chunks.repeated(docs, spark), spark, "chunk-removals")
    clean = F.col("_clean.clean")
    return line_chunks.cleaned(docs, gone).select(
        "doc_id", "_clean.n_chunks", "_clean.removed_chunks", "_clean.removed_lines",
        F.char_length(clean).cast("bigint").alias("clean_chars"), F.sha2(clean, 256).alias("clean_sha256"),
    )


def op11_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), spark)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_digest(turn_repair.damaged(_table(spark, sf_dir, "conversations")), spark)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), packing.tokenizer_path())


QUERIES = {
    f.__name__: f
    for f in (
        op1_preference_format, op2_risk_controlled_rules, op3_licence_digests, op4_ngram_jaccard, op5_context_tree, op6_pack_least_squares, op7_mix_sources, op8_url_rules,
        op9_exact_dedup, op10_line_chunks, op11_dual_tree_search, op12_turn_repair, op13_token_counts,
    )
}
