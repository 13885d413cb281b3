"""Extra columns that are named as columns the operators make, null links, and shards against a plain cut."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, html_text, near_dedup, packing, sharding, token_counts
from tidemark.llm.components import components

NAMES = (
    "ids decoded n digest sig bands doc a b bucket members weight p component node large row key size place part total "
    "shard slot piece start length offset sequence_id group bin n_tokens n_bytes over_limit kept component_id __place"
).split()
ROWS = [(1, "one two three four five six"), (2, "one two three four five six"), (3, None), (4, ""), (5, "x" * 3000), (None, "no id"), (1, "again")]


OPERATORS = {
    "round_trip": lambda d: byte_bpe.round_trip(d, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN),
    "token_counts": lambda d: token_counts.token_counts(d, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN),
    "html_text": lambda d: html_text.extract(d, html_text.Model({}, {}), key="doc_id", html="text"),
    "near_duplicates": lambda d: near_dedup.near_duplicates(d, size=4).select("doc_id", "n_shingles", "component_id", "kept"),
    "pack": lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "piece", "start", "length"),
    "shards": lambda d: sharding.shards(d, 3).select("doc_id", "size", "shard", "slot"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(docs, name):
    plain = docs(ROWS)
    wide = plain.select("*", *[F.lit("clash").alias(n) for n in NAMES])
    results = [sorted(map(str, OPERATORS[name](df).collect())) for df in (plain, wide)]
    assert results[0] == results[1] and results[0]


def test_links_with_nulls_and_other_columns(spark):
    links = spark.createDataFrame([(1, 2, "x"), (2, 3, "y"), (5, 5, "z"), (None, 7, ""), (8, None, "")], "a int, b int, component string")
    found = sorted((r["node"], r["component"]) for r in components(links.unionByName(links)).collect())
    assert found == [(1, 1), (2, 1), (3, 1)]


def test_shards_against_a_plain_cut(docs):
    rows = [(k, "y" * (k * 37 % 101)) for k in range(500)] + [(600, "z" * 5000)]
    sizes = [len(t) + 1 for _, t in rows]
    total, before, wanted = sum(sizes), 0, {}
    for (doc, _), size in zip(rows, sizes):
        wanted[doc] = (2 * before + size) * 8 // (2 * total)  # where the middle byte lies
        before += size
    for part_rows in (50, 100_000):
        got = {r["doc_id"]: r["shard"] for r in sharding.shards(docs(rows), 8, part_rows=part_rows).collect()}
        assert got == wanted
