"""Queries of the training-data operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_dedup, oracles, packing, page_outcomes, pii, rule_ensemble, sharding, token_counts, topk, toxicity, url_reputation
from tidemark.llm.common import batches, materialize, table
from tidemark.llm.tokens import token_counter

# The rules of the URL query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = token_counter(spark)
    lengths = table(spark, sf_dir, "documents").select(count(F.col("text")).alias("n_tokens"))
    with batches(spark):
        histogram = materialize(token_counts.histogram(lengths), "token-histogram")
    return token_counts.suffix_sums(histogram)


def fold(modulus: int, column: str = "doc_id"):
    """crc32 of the id as text, mod modulus."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> rule_ensemble.RuleModel:
    labels = table(spark, sf_dir, "labels").where(fold(3) != 1).select("doc_id", F.col("quality").alias("label"))
    return rule_ensemble.learn(docs, labels)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = rule_ensemble.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def _only(kind: str):
    return lambda k: F.when(k == kind, k).otherwise("")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.extract(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, _only(k)), "")).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return got.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(4) != 2).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.learn(docs, labels).score(docs)
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    judge = page_outcomes.learn(table(spark, sf_dir, "documents"), labels)
    pages = page_outcomes.outcomes(table(spark, sf_dir, "pages").select("page_id", "url", "html"), judge, "bad")
    judged = url_reputation.judge(pages, URL_RULES, "bad")
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"), 40)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)).alias("kept"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_token_counts, op3_quality_rules, op4_topk, op5_pii, op6_toxicity, op7_decontamination, op8_url_reputation, op9_sharding, op10_near_dedup)}

ORACLE_SQL: dict[str, str] = {
    "op4_topk": oracles.TOP_K,
    "op7_decontamination": oracles.DECONTAMINATION,
    "op8_url_reputation": oracles.url_reputation(URL_RULES),
    "op10_near_dedup": oracles.NEAR_DEDUP,
}
