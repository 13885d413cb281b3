"""Quality rules in DataFrame functions only: measures of each text, and lines that much of a host repeats.

Cross-document line frequency: every line is normalised (blanks at its ends removed, lower case, digits
as 0) and hashed; for each host the distinct texts that hold a line are counted. Lines in more than
``max_share`` of the host's texts are boilerplate, if they are in ``min_texts`` of them at least, which only matters
for hosts of less than ``min_texts / max_share`` texts; ``cleaned`` is the text without them, and a text of whose
words less than ``min_left`` then remain is depleted. The base measures are
those of the whole text. Documents with the same text count once: they are for deduplication to remove, and would
otherwise be rejected together, the one that is to stay included.

Contract. A null or empty text has no words and fails the base rules. A null host is a host of its own.
Every row gives one row, repeated rows included. An empty table gives an empty result. Extra columns
are kept in ``row``, a struct of the whole input row, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted
from tidemark.session import stage

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _repeat_words(words: Column, size: Column) -> Column:
    """Places of ``words`` that lie in a 3-word window found twice or more."""
    starts = F.sequence(F.lit(0), size - 3)
    window = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(size >= 4, window).otherwise(F.array().cast("array<bigint>"))


def measures(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``row`` (the input row), the base measures, ``base_failed``, and the hashes that name host and text."""
    t = F.coalesce(quoted(text), F.lit(""))
    first = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
        quoted(host).alias("host"),
        t.alias("text"),
        F.xxhash64(t).alias("text_hi"),
        F.hash(t).alias("text_lo"),
        F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(t, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))).alias("lines"),
    )
    counted = first.select(
        "row", "host", "text_hi", "text_lo",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", BLANK, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("words"), F.size("words")).alias("windows"),
    )
    # windows sorted with their places; equal neighbours are repeated windows
    sorted_windows = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    placed = counted.withColumn("sorted", sorted_windows)
    again = F.filter(
        "sorted",
        lambda w, k: (F.get("sorted", k - 1)["h"] == w["h"]) | (F.get("sorted", k + 1)["h"] == w["h"]),
    )
    covered = F.array_distinct(F.flatten(F.transform(again, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2))))
    n_repeat = F.coalesce(F.size(covered), F.lit(0))
    measured = placed.select(
        "row", "host", "text_hi", "text_lo", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("sorted").isNull(), F.lit(0)).otherwise(n_repeat).cast("bigint").alias("n_repeat_words"),
        F.monotonically_increasing_id().alias("number"),
    )
    # a filter on the verdict must not be pushed below the row number: its conditions would then hold the
    # whole expressions above, one inside the other, and compute them anew for each word
    return measured.where("number >= 0").drop("number").withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _normal(line: Column) -> Column:
    """Hash of a line without blanks at its ends, in lower case, with digits as 0."""
    return F.xxhash64(F.regexp_replace(F.lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))), "[0-9]", "0"))


def frequent_lines(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    max_share: float = 0.1,
    min_texts: int = 3,
    min_left: float = 0.3,
) -> DataFrame:
    """(host, text_hi, text_lo, cut, depleted) of the texts that hold frequent lines: their hashes, and what removing them leaves."""
    t = F.coalesce(quoted(text), F.lit(""))
    lines = docs.select(
        quoted(host).alias("host"), F.xxhash64(t).alias("text_hi"), F.hash(t).alias("text_lo"),
        F.explode(F.split(t, "\n", -1)).alias("line"),
    ).select(
        "host", "text_hi", "text_lo", _normal(F.col("line")).alias("line"),
        F.regexp_count("line", F.lit(WORD)).cast("bigint").alias("words"),
    ).where("words > 0")
    by_text = lines.select("host", "text_hi", "text_lo", "line").distinct()
    texts = docs.select(quoted(host).alias("host"), F.xxhash64(t).alias("text_hi"), F.hash(t).alias("text_lo"))
    hosts = texts.distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    found = by_text.groupBy("host", "line").agg(F.count(F.lit(1)).alias("found")).where(F.col("found") >= min_texts)
    found, hosts = found.alias("f"), hosts.alias("h")
    frequent = found.join(hosts, F.col("f.host").eqNullSafe(F.col("h.host"))).where(
        F.col("found") > max_share * F.col("texts")
    ).select(F.col("f.host").alias("f_host"), F.col("line").alias("f_line"))
    # stored, so that its size is known when the lines meet it: they are shuffled only if it is large
    frequent = stage(frequent, "frequent")
    judged = lines.join(
        frequent, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line")), "left"
    )
    # copies of a text multiply its words by the same number, so shares of words stay right
    removed = F.sum(F.when(F.col("f_line").isNotNull(), F.col("words")).otherwise(0))
    return (
        judged.groupBy("host", "text_hi", "text_lo")
        .agg(F.sum("words").alias("words"), removed.alias("removed"), F.collect_set("f_line").alias("cut"))
        .where(F.col("removed") > 0)
        .select(
            "host", "text_hi", "text_lo", "cut",
            (F.col("words") - F.col("removed") < min_left * F.col("words")).alias("depleted"),
        )
    )


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    max_share: float = 0.1,
    min_texts: int = 3,
    min_left: float = 0.3,
) -> DataFrame:
    """``row``, the base measures, ``base_failed``, ``depleted``, ``kept`` and ``cleaned`` (the text without frequent lines) of every row."""
    rows = measures(docs, text, host).alias("m")
    found = frequent_lines(docs, text, host, max_share, min_texts, min_left).alias("d")
    same = (
        F.col("m.host").eqNullSafe(F.col("d.host"))
        & (F.col("m.text_hi") == F.col("d.text_hi"))
        & (F.col("m.text_lo") == F.col("d.text_lo"))
    )
    joined = rows.join(found, same, "left")
    depleted = F.coalesce("d.depleted", F.lit(False))
    whole = F.col("row")[text]
    left = F.filter(F.split(whole, "\n", -1), lambda line: ~F.array_contains("cut", _normal(line)))
    return joined.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        depleted.alias("depleted"), (~F.col("base_failed") & ~depleted).alias("kept"),
        F.when(F.col("cut").isNull(), whole).otherwise(F.array_join(left, "\n")).alias("cleaned"),
    )


#: The same in SQL: hosts are ``source``, limits as the defaults above.
SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t
), l AS (
  SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM t
), lw AS (
  SELECT r, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         regexp_replace(lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[0-9]', '0', 'g') AS norm
  FROM l
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw WHERE words > 0 GROUP BY r
), pos AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM pos) WHERE c > 1
), cov AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r
), by_text AS (
  SELECT source, text, norm, sum(words) AS words FROM lw WHERE words > 0 GROUP BY ALL
), hosts AS (
  SELECT source, count(DISTINCT text) AS texts FROM t GROUP BY source
), freq AS (
  SELECT b.source, b.norm FROM by_text b JOIN hosts h ON b.source IS NOT DISTINCT FROM h.source
  GROUP BY b.source, b.norm, h.texts HAVING count(*) >= 3 AND count(*) > 0.1 * h.texts
), poor AS (
  SELECT b.source, b.text FROM by_text b LEFT JOIN freq f
    ON b.source IS NOT DISTINCT FROM f.source AND b.norm = f.norm
  GROUP BY b.source, b.text
  HAVING sum(CASE WHEN f.norm IS NOT NULL THEN words ELSE 0 END) > 0
     AND sum(CASE WHEN f.norm IS NULL THEN words ELSE 0 END) < 0.3 * sum(words)
), base AS (
  SELECT w.r, w.doc_id, w.source, w.text, len(ws) AS n_words,
         length(regexp_replace(w.text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN cov USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT EXISTS (SELECT 1 FROM poor p WHERE p.source IS NOT DISTINCT FROM base.source AND p.text = base.text) AS kept
FROM base
"""
