"""Line deduplication by range partitions of line hashes, with compressed keep bitmaps as the result.

Every line long enough gives a row (hash, document, positions). The rows are range-partitioned and
sorted by hash, then document from the largest down. One stream over each partition sees the
documents of a line one after another: the first one keeps the line, and once the third distinct one
is met, all but the first lose it. The range bounds lie between documents too, so a line that a third
of all documents hold is spread over many partitions; the first and the last line of a partition,
which may go on in its neighbours, are settled afterwards from their totals over all partitions, two
lines for each partition at most. The result is one zlib-compressed bitmap for each document that
loses lines, never text.

Contract. A line's key is the line without the blanks ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower
case. Keys of at least ``min_chars`` code points in at least ``min_docs`` documents stay in the largest
document id only. A null or empty text is one empty line. Rows with the same id are one document: its
lines count once, and each row loses the same lines. A null id is a document smaller than all others.
An empty table gives an empty result. Extra columns are handed through untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows, own_names, prepare, quoted
from tidemark.session import stage

BLANKS = b" \t\n\x0b\x0c\r"
_SIGN = 1 << 63


def _text_id(raw: bytes) -> int:
    """Tells texts of one document id apart."""
    return xxhash.xxh3_64_intdigest(raw) - _SIGN


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each document and distinct key: (hi, lo, doc, text_id, positions)."""

    def work(batch):
        hi, lo, doc, texts, places = [], [], [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = (text or "").encode("utf-8")
            seen: dict[bytes, list[int]] = {}
            for number, line in enumerate(raw.split(b"\n")):
                line = line.strip(BLANKS).lower()
                # bytes of a UTF-8 text that start a code point
                if len(line) >= min_chars and len(line.decode("utf-8")) >= min_chars:
                    seen.setdefault(line, []).append(number)
            text_id = _text_id(raw)
            for line, numbers in seen.items():
                value = xxhash.xxh3_128_intdigest(line)
                hi.append((value >> 64) - _SIGN)
                lo.append((value & (2 * _SIGN - 1)) - _SIGN)
                doc.append(key)
                texts.append(text_id)
                places.append(numbers)
        return [hi, lo, doc, texts, places]

    kind = docs.schema["doc"].dataType.simpleString()
    return map_rows(docs, work, f"hi bigint, lo bigint, doc {kind}, text_id bigint, places array<int>")


def _stream(min_docs: int):
    """The pass over one sorted partition; ``verdict`` is 1 for lost lines and 0 for lines still open."""

    names = ["hi", "lo", "doc", "text_id", "places", "verdict", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[tuple] = []  # rows of the run at hand while its fate is open
        line, docs, head, opening, kind, same = None, 0, None, True, None, None

        def pack(rows):
            columns = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64(), pa.int64(), kind, pa.int64(), pa.list_(pa.int32()), pa.int8(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            kind = batch.schema.field("doc").type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:4] == same:
                    continue  # a repeated row of one document
                same = row[:4]
                if row[:2] != line:
                    if opening and line is not None:
                        opening = False
                    held = []  # a run that ends with too few documents loses nothing
                    line, docs, last = row[:2], 0, object()
                fresh = docs == 0 or row[2] != last
                last = row[2]
                docs += fresh
                head = row[2] if docs == 1 else head
                if opening:
                    out.append((*row, 0, fresh))  # may have begun in the partition before
                elif docs > 1 and docs >= min_docs:
                    out.extend((*r, 1, f) for r, f in held if r[2] != head)
                    held = []
                    out.append((*row, 1, fresh))
                else:
                    held.append((row, fresh))
                if len(out) >= 4096:
                    yield pack(out)
                    out = []
        if line is not None and not opening:
            # the last run may go on in the next partition; what is lost for certain is out already
            out.extend((*r, 0, f) for r, f in held)
            if docs >= min_docs:
                out.append((*line, head, 0, [], 0, True))
                out.extend((*line, None, 0, [], 0, True) for _ in range(min_docs - 1))
        if out:
            yield pack(out)

    return run


def drops(docs: DataFrame, key: str, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """(doc, text_id, places): the lines that each text loses."""
    spark = prepare(docs.sparkSession)
    lines = _lines(own_names(docs, {"doc": key, "text": text}), min_chars)
    kind = lines.schema["doc"].dataType
    order = ["hi", "lo", F.col("doc").desc_nulls_last()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text_id")
    schema = T.StructType(lines.schema.fields + [
        T.StructField("verdict", T.ByteType()), T.StructField("first", T.BooleanType())
    ])
    passed = stage(ranged.mapInArrow(_stream(min_docs), schema), "lines")
    lost = passed.where("verdict = 1").select("doc", "text_id", "places")
    # open lines: at most the first and the last of each partition
    still = passed.where("verdict = 0")
    totals = still.groupBy("hi", "lo").agg(
        F.count_if("first").alias("docs"), F.max("doc").alias("head")
    ).where(F.col("docs") >= min_docs)
    settled = (
        still.where(F.size("places") > 0)
        .join(F.broadcast(totals), ["hi", "lo"])
        .where(~F.col("doc").eqNullSafe(F.col("head")))
        .select(F.col("doc").cast(kind), "text_id", "places")
    )
    return lost.unionByName(settled)


def bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """(doc, text_id, n_dropped, dropped) of each text that loses lines.

    ``dropped`` is a zlib-compressed bitmap, bit ``k`` (from the lowest of the first byte) set where
    line ``k`` goes; all further lines stay. Texts that are not listed keep every line.
    """
    lost = drops(docs, key, text, min_chars, min_docs)
    # a set of places, so that repeated rows of a document add nothing
    by_text = lost.select("doc", "text_id", F.explode("places").alias("place")).groupBy("doc", "text_id").agg(
        F.collect_set("place").alias("places")
    )

    def work(batch):
        marks, counts = [], []
        for places in batch.column(2).to_pylist():
            bits = np.zeros(max(places) + 1, np.uint8)
            bits[places] = 1
            counts.append(len(places))
            marks.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        return [batch.column(0), batch.column(1), counts, marks]

    kind = by_text.schema["doc"].dataType.simpleString()
    return map_rows(by_text, work, f"doc {kind}, text_id bigint, n_dropped bigint, dropped binary")


def keep_lines(text: str | None, dropped: bytes | None) -> tuple[int, str | None]:
    """Number of lines of ``text``, and the text without the lines marked in ``dropped``."""
    lines = (text or "").split("\n")
    if dropped is None:
        return len(lines), text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(dropped), np.uint8), bitorder="little")
    return len(lines), "\n".join(line for k, line in enumerate(lines) if k >= len(bits) or not bits[k])


def apply_bitmaps(docs: DataFrame, marks: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, its texts without the dropped lines, with ``n_lines`` and ``n_dropped``."""
    text_ids = _text_ids(docs, key, text)
    joined = text_ids.join(
        marks.select(F.col("doc").alias("__doc"), F.col("text_id").alias("__text_id"), "n_dropped", "dropped"),
        F.col("__row.__key").eqNullSafe(F.col("__doc")) & (F.col("__row.__text_id") == F.col("__text_id")),
        "left",
    ).select("__row", F.col("n_dropped").alias("__n"), F.col("dropped").alias("__dropped"))
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            columns = [row.field(k) for k in range(len(docs_names))]
            done = [keep_lines(t, d) for t, d in zip(columns[place].to_pylist(), batch.column(2).to_pylist())]
            columns[place] = pa.array([t for _, t in done], type=pa.string())
            n_dropped = pa.array([n or 0 for n in batch.column(1).to_pylist()], type=pa.int64())
            out = [*columns, pa.array([n for n, _ in done], type=pa.int64()), n_dropped]
            yield pa.RecordBatch.from_arrays(out, names=[*docs_names, "__n_lines", "__n_dropped"])

    docs_names = docs.columns
    schema = T.StructType([
        *docs.schema.fields, T.StructField("__n_lines", T.LongType()), T.StructField("__n_dropped", T.LongType())
    ])
    return joined.mapInArrow(run, schema)


def _text_ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    """All columns of ``docs`` in a struct ``__row``, with ``__key`` and ``__text_id`` (the digest of the text)."""
    names = docs.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            columns = [row.field(k) for k in range(len(names) + 1)]
            digests = [_text_id((t or "").encode("utf-8")) for t in columns[place].to_pylist()]
            fields = [*names, "__key", "__text_id"]
            made = pa.StructArray.from_arrays([*columns, pa.array(digests, type=pa.int64())], names=fields)
            yield pa.RecordBatch.from_arrays([made], names=["__row"])

    prepare(docs.sparkSession)
    row: Column = F.struct(*[quoted(n) for n in names], quoted(key).alias("__key"))
    struct = docs.select(row.alias("__row"))
    made = T.StructType([*struct.schema["__row"].dataType.fields, T.StructField("__text_id", T.LongType())])
    return struct.mapInArrow(run, T.StructType([T.StructField("__row", made)]))


def line_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """All columns of ``docs`` with the lines removed, and ``__n_lines`` and ``__n_dropped``."""
    return apply_bitmaps(docs, bitmaps(docs, key, text, min_chars, min_docs), key, text)


#: The digest query in SQL, with the default limits.
SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), l AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM t
), k AS (
  SELECT r, doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM l
), hot AS (
  SELECT norm, max(doc_id) AS head FROM k WHERE length(norm) >= 20 GROUP BY norm HAVING count(DISTINCT doc_id) >= 3
), j AS (
  SELECT k.*, hot.norm IS NOT NULL AND doc_id <> hot.head AS gone FROM k LEFT JOIN hot USING (norm)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""
