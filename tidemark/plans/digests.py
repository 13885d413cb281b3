"""Comparing stored tables bucket by bucket: only buckets whose digests differ are read.

A table in hash buckets of its key has a table of digests beside it, one row for each bucket. A digest also holds a
mark of the bucket's files and of the table's schema. Files are never changed in place, so a digest is
up to date as long as its mark is: whoever wrote the table, only buckets with another mark are read again.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators.buckets import MEASURES, KeyBuckets, differing, digests
from tidemark.operators.changes import snapshot_diff
from tidemark.operators.merge import key_list
from tidemark.operators.quality import relation_diff
from tidemark.operators.snapshot import SnapshotColumns, snapshot
from tidemark.plans.incremental import read_buckets
from tidemark.plans.snapshots import grow
from tidemark.session import stage, staging
from tidemark.sources import tables

MARK = "file_mark"
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def layout(spark: SparkSession, name: str) -> KeyBuckets:
    buckets = tables.key_buckets(spark, name)
    if buckets is None:
        raise ConfigError(f"{name} is not laid out by hash buckets")
    return buckets


def file_marks(spark: SparkSession, name: str) -> DataFrame:
    """``bucket`` and a mark of its files' names, sizes and times; the files are listed and not opened."""
    schema = spark.table(name).schema.simpleString()
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(tables.location(spark, name))
        .select("path", "length", "modificationTime")
    )
    bucket = F.url_decode(F.regexp_extract("path", f"/{tables.BUCKET}=([^/]*)/", 1))
    one = F.xxhash64(F.lit(schema), F.substring_index("path", "/", -1), "length", F.unix_micros("modificationTime"))
    return files.select(bucket.alias("bucket"), one.alias("one")).groupBy("bucket").agg(
        F.concat_ws(
            ":", F.count(F.lit(1)), F.sum(F.shiftright("one", 32)), F.sum(F.col("one").bitwiseAND(F.lit(0xFFFFFFFF))),
            F.bit_xor("one"),
        ).alias(MARK)
    )


def table_digests(spark: SparkSession, name: str) -> DataFrame:
    """The digest of each bucket of a stored table, brought up to date.

    Buckets whose files are those of their stored digest are not read.
    """
    layout(spark, name)
    kept = f"{name}__digests"
    spark.catalog.refreshTable(name)
    marks = stage(file_marks(spark, name), "marks")
    known = None
    stale = marks.select("bucket")
    if tables.is_table(spark, kept):
        spark.catalog.refreshTable(kept)
        known = spark.table(kept).join(marks, ["bucket", MARK], "left_semi")
        stale = marks.join(spark.table(kept), ["bucket", MARK], "left_anti").select("bucket")
        if stale.isEmpty() and spark.table(kept).join(marks, "bucket", "left_anti").isEmpty():
            return spark.table(kept)
    ids = [r[0] for r in stale.collect()]  # no more than the table has buckets
    rows = spark.table(name).where(F.col(tables.BUCKET).isin(ids))
    columns = [c for c in rows.columns if c != tables.BUCKET]
    fresh = digests(rows, F.col(tables.BUCKET), columns).join(marks, "bucket").select("bucket", *MEASURES, MARK)
    if known is not None:
        fresh = known.select("bucket", *MEASURES, MARK).unionByName(fresh)
    tables.create_table_as(fresh.coalesce(1), kept)
    spark.catalog.refreshTable(kept)
    return spark.table(kept)


def changed_buckets(spark: SparkSession, before: str, after: str) -> DataFrame:
    """Buckets that two tables of the same layout do not share."""
    if layout(spark, before) != layout(spark, after):
        raise ConfigError(f"{before} and {after} have different hash buckets")
    return differing(table_digests(spark, before), table_digests(spark, after))


def _differing_rows(spark: SparkSession, before: str, after: str) -> tuple[DataFrame, DataFrame]:
    left, right = (tables.read_table(spark, n) for n in (before, after))
    same = {f.name: f.dataType for f in left.schema.fields} == {f.name: f.dataType for f in right.schema.fields}
    if not same:
        # digests of other columns say nothing
        return left, right
    ids = changed_buckets(spark, before, after)
    return read_buckets(spark, before, ids)[0], read_buckets(spark, after, ids)[0]


def stored_diff(
    spark: SparkSession, before: str, after: str, keys: str | Sequence[str], *, compare: Sequence[str] | None = None
) -> DataFrame:
    """``snapshot_diff`` of two stored states, over the buckets that differ.

    Both must be laid out by hash buckets of ``keys`` or of some of them, in equal number.
    """
    if not layout(spark, before).covers(keys):
        raise ConfigError(f"the hash buckets of {before} are not those of the key")
    return snapshot_diff(*_differing_rows(spark, before, after), key_list(keys), compare=compare)


def stored_relation_diff(spark: SparkSession, a: str, b: str) -> DataFrame:
    """``relation_diff`` of two stored tables, over the buckets that differ; equal buckets add nothing to it."""
    return relation_diff(*_differing_rows(spark, a, b))


def snapshot_stored(
    spark: SparkSession,
    name: str,
    source: str,
    unique_key: str | Sequence[str],
    *,
    now: datetime.datetime,
    columns: SnapshotColumns = SnapshotColumns(),
    **options,
) -> str:
    """Run a snapshot of a stored table in hash buckets; options as for ``snapshot``.

    The open versions are kept by the source's buckets, the versions closed by a run in a partition of
    their own. A run reads the source and the open versions in those buckets only that changed since the run
    before, and rewrites those open versions. The digests a run has seen are stored after its rows, so
    a run that failed is done again from where it was.
    """
    buckets = layout(spark, source)
    if not buckets.covers(unique_key):
        raise ConfigError(f"the hash buckets of {source} are not those of the key")
    options = {**options, "now": now, "columns": columns}
    seen = f"{name}__seen"
    run = f"closed {now.isoformat(sep=' ')} {uuid.uuid4().hex[:12]}"
    # stored, as the source may change while the run goes on
    with staging(spark):
        current = stage(table_digests(spark, source).select("bucket", *MEASURES), "digests")

        def placed(df: DataFrame) -> DataFrame:
            is_open = F.col(columns.valid_to).isNull()
            own = F.concat(F.lit("open "), buckets.id_expr(df.schema))
            return df.withColumn(tables.BUCKET, F.when(is_open, own).otherwise(run))

        if not tables.is_table(spark, name):
            tables.create_table_as(placed(snapshot(None, tables.read_table(spark, source), unique_key, **options)), name)
            outcome = "created"
        else:
            before = spark.table(seen) if tables.is_table(spark, seen) else current.limit(0)
            changed = stage(differing(before, current), "changed")
            rows, _ = read_buckets(spark, source, changed)
            opened = changed.select(F.concat(F.lit("open "), "bucket").alias("id"))
            fixed = stage(rows, "source")
            result = snapshot(read_buckets(spark, name, opened)[0], fixed, unique_key, **options)
            if grow(spark, name, result.schema):
                result = snapshot(read_buckets(spark, name, opened)[0], fixed, unique_key, **options)
            tables.replace_partitions(placed(result), name, read_buckets(spark, name, opened)[1])
            outcome = "updated"
        tables.create_table_as(current.coalesce(1), seen)
    return outcome
