"""From raw documents to packed sequences: each stage calls one operator of ``tidemark.llm``.

Every stage takes all documents that the one before kept and is written as Parquet before the next one
reads it. All but the last return the columns of ``documents``. A null or empty table passes through:
empty texts fail the quality rules, so an empty result is a defined one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, near_dedup, packing, quality_rules, toxicity
from tidemark.llm.common import prepare
from tidemark.llm.queries import table, toxicity_model
from tidemark.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents with this score or more are rejected.
TOXIC = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted of lines of their own, without the frequent lines of their host."""
    prepare(spark)
    judged = quality_rules.quality_rules(docs.select(*COLUMNS))
    return judged.where("kept").select(
        "row.doc_id", F.col("cleaned").alias("text"), "row.lang", "row.source",
        F.length("cleaned").cast("bigint").alias("n_chars"),
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the limit. The classifier learns from the labelled ones that are left."""
    prepare(spark)
    docs = docs.select(*COLUMNS)
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    whole = docs.select(F.struct(*COLUMNS).alias("row"), "text")
    scored = toxicity.score(whole, model, key="row")
    return scored.where(F.col("score") < TOXIC).select(*[F.col(f"row.{c}").alias(c) for c in COLUMNS])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others hold as well; those of which no word is left go."""
    prepare(spark)
    done = line_dedup.line_dedup(docs.select(*COLUMNS))
    whole = done.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))
    return whole.where(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    prepare(spark)
    docs = docs.select(*COLUMNS)
    groups = near_dedup.near_duplicates(docs, size=5, threshold=0.8)
    dropped = groups.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_quality),
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("packing", pack),
]

#: No SQL for the classifier, the verified groups and the packing; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
