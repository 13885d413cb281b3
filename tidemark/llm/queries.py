"""One query for each operator of this folder, over the whole of its table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann,
    byte_bpe,
    html_text,
    line_dedup,
    near_dedup,
    packing,
    periodic_runs,
    private_data,
    quality_rules,
    sharding,
    token_alignment,
    token_counts,
    toxicity,
)
from tidemark.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: The document a page was made from, at the end of its path: labelled pages for the weights.
PAGE_DOC = r"^[^?#]*?/([0-9]+)(?:[.]html?)?/?(?:[?#].*)?$"


def labelled_pages(pages: DataFrame, docs: DataFrame, sample: int = html_text.SAMPLE) -> DataFrame:
    """(html, text) of at most ``sample`` pages whose document is known, chosen by the hash of their id."""
    doc = F.regexp_extract("url", PAGE_DOC, 1).try_cast("bigint")
    named = pages.select("page_id", doc.alias("doc_id")).where("doc_id IS NOT NULL AND page_id IS NOT NULL")
    chosen = named.groupBy("page_id").agg(F.min("doc_id").alias("doc_id")).orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    # only the ids are broadcast, a bounded number, and cut both tables down before they meet; a repeated id counts once
    shown = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").groupBy("page_id", "doc_id").agg(
        F.min("html").alias("html")
    )
    told = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    return shown.join(told.groupBy("doc_id").agg(F.min("text").alias("text")), "doc_id").select("html", "text")


@query("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = html_text.fit(labelled_pages(pages, table(spark, sf_dir, "documents")))
    text = html_text.extract(pages.select(F.struct("page_id", "url").alias("page"), "html"), model, key="page")
    return text.select("page.page_id", "page.url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold=0.8)


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op5_line_dedup", line_dedup.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op6_quality_rules", quality_rules.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op7_ann")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sharding.shards(table(spark, sf_dir, "documents"), count=8)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    train = ~toxicity.held_out(F.col("doc"))
    return toxicity.fit(toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", train, toxicity.SAMPLE))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def repeat_words(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """One document in ten repeats its words from some place on, as the hash of its id says."""
    if doc_id is None or not len(words):
        return words
    number = zlib.crc32(str(doc_id).encode())
    if number % 10:
        return words
    rest = number // 10
    start = rest % len(words)
    period = 1 + (len(words) - start) // (3 + rest % 8)
    place = np.arange(len(words))
    return words[np.where(place < start, place, start + (place - start) % period)]


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.periodic_runs(docs, change=repeat_words).drop("runs")


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.token_alignment(docs, *paths)[0]


@query("op13_private_data")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.find(table(spark, sf_dir, "documents"))
