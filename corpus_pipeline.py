"""A training corpus in five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_dedup, packing, pii, rule_ensemble
from tidemark.llm.common import inner, materialize, table
from tidemark.llm.queries import quality_model

#: Rows up to which ids (or spans) are broadcast to the documents.
BROADCAST_IDS, BROADCAST_SPANS = 2_000_000, 200_000
#: A row's own key inside a stage.
KEY = inner("key")


def keyed(docs: DataFrame, label: str) -> DataFrame:
    """docs, stored, with a key of every row's own; ids may be null or repeated."""
    return materialize(docs.withColumn(KEY, F.monotonically_increasing_id()), label)


def without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs of keyed() without the rows whose KEY is removed."""
    removed = materialize(removed.select(KEY), "removed")
    return docs.join(F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed, KEY, "left_anti").drop(KEY)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble takes for good ones; a document without an id is judged like any other."""
    score = inner("score")
    scored = rule_ensemble.score(docs, quality_model(spark, docs, sf_dir), score)
    return scored.where(F.col(score) >= 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest id (one without an id only where none has one), and one wordless row of each id."""
    docs = keyed(docs, "near-dedup-rows")
    found = near_dedup.near_duplicates(docs, id_col=KEY)
    own = docs.select(KEY, "doc_id", F.xxhash64("text").alias("hash"))
    found = materialize(found.join(own, KEY), "near-duplicates")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "hash", KEY)
    full, named = F.col("n_shingles") > 0, F.col("doc_id").isNotNull()
    group = [F.when(full, 0).when(named, 1).otherwise(2).alias("kind"), F.when(full, F.col("component")).when(named, F.col("doc_id")).otherwise(F.col(KEY)).alias("group")]
    kept = found.groupBy(*group).agg(F.min(place).alias("first")).select(f"first.{KEY}")
    return without(docs, found.join(kept, KEY, "left_anti"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ten words of a benchmark item."""
    docs = keyed(docs, "decontamination-rows")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), id_col=KEY)
    return without(docs, found.where("n_hit > 0").select(F.col("doc_id").alias(KEY)))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs, BROADCAST_SPANS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents by length bucket and token-budget batch."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_duplicates), ("decontamination", decontaminated), ("pii", masked), ("packing", packed)]

# the rule ensemble and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
