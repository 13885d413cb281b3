"""Replace whole partitions of a target."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators.merge import _align, col, insert_rows
from tidemark.operators.partition import PartitionSpec
from tidemark.operators.sizing import key_set, split_by_keys


def partition_values(target: DataFrame, partition: PartitionSpec, values: Sequence[Any], truncate: bool) -> DataFrame:
    """Listed partition values as a one-column DataFrame of the partition type."""
    spark = target.sparkSession
    literals = [partition.literal(v) for v in values]
    if truncate:
        literals = [partition.bucket_expr(v) for v in literals]
    return spark.range(1).select(F.explode(F.array(*literals)).alias("bucket"))


def insert_overwrite(
    target: DataFrame,
    source: DataFrame,
    partition: PartitionSpec,
    *,
    partitions: Sequence[Any] | None = None,
    copy: bool | None = None,
    dest_columns: Sequence[str] | None = None,
) -> DataFrame:
    """The target after its partitions are replaced by the source's rows.

    Without ``partitions`` the replaced set is every non-NULL partition found in the
    source; source rows whose partition is NULL are appended. With ``partitions`` the
    listed ones are emptied even if the source has no row for them, and source rows
    outside the list are still inserted. ``copy`` replaces whole partitions instead:
    with a list, source rows outside it are not taken; without one, a source row with
    a NULL partition is an error, because it has no partition to be copied to.
    """
    if partition is None:
        raise ConfigError("insert_overwrite needs a partition")
    copy = partition.copy_partitions if copy is None else copy
    dest = list(dest_columns or target.columns)
    source = _align(source, target, dest)
    bucket = partition.bucket_expr()
    if partitions:
        replaced = key_set(partition_values(target, partition, partitions, truncate=copy))
        rows = split_by_keys(source, bucket, replaced)[0] if copy else source
    else:
        replaced = key_set(source.select(bucket.alias("bucket")))
        rows = source
        if copy:
            rows = source.where(
                F.assert_true(
                    col(partition.column_name).isNotNull(),
                    "copy: a source row has no partition",
                ).isNull()
            )
    _, kept = split_by_keys(target, bucket, replaced)
    return kept.unionByName(insert_rows(target, rows, dest))


def overwrite_buckets(
    target: DataFrame,
    source: DataFrame,
    partition: PartitionSpec,
    params: DataFrame,
    param_name: str,
    *,
    source_param: str | None = None,
) -> DataFrame:
    """Replace exactly the partitions named by a parameter column, for all parameters at once.

    Only source rows inside a named partition are inserted. When the source was fanned
    out over the same parameters, ``source_param`` names the column that carries each
    row's own parameter, and a row counts only for the partition it was computed for.
    """
    if partition is None or not partition.is_time:
        raise ConfigError("overwrite_buckets needs a time partition")
    if partition.copy_partitions:
        raise ConfigError("overwrite_buckets does not copy partitions")
    if source_param is not None:
        own = partition.bucket_expr(col(source_param))
        source = source.where(partition.bucket_expr() == own).drop(source_param)
    source = _align(source, target, target.columns)
    buckets = key_set(params.select(partition.bucket_expr(col(param_name)).alias("bucket")))
    _, kept = split_by_keys(target, partition.bucket_expr(), buckets)
    rows, _ = split_by_keys(source, partition.bucket_expr(), buckets, partition.span(source))
    return kept.unionByName(insert_rows(target, rows, target.columns))


def delete_where(target: DataFrame, predicate: str) -> DataFrame:
    """Drop rows for which the predicate is true; a NULL outcome keeps the row."""
    return target.where(~F.coalesce(F.expr(predicate), F.lit(False)))
