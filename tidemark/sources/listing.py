"""Catalog input of real tables: sizes and row counts from file footers, columns from schemas."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.catalog import column_rows
from tidemark.sources import tables


def real_tables(spark: SparkSession, database: str, names: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``tables`` and ``columns`` as ``catalog_report`` takes them, for a database or some of its tables.

    Sizes are those of the files; a count without columns or filters reads only the files' footers.
    The driver handles one entry for each table asked for.
    """
    known = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    wanted = sorted(set(known) if names is None else set(known) & set(names))
    stats, columns = [], []
    for name in wanted:
        full = f"{database}.{name}"
        df = tables.read_table(spark, full)
        files = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        by_file = files.groupBy("file", "size").agg(F.count(F.lit(1)).alias("n"))
        stats.append(
            by_file.agg(
                F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")
            ).select(
                F.lit(database).alias("table_schema"), F.lit(name).alias("shard_name"),
                F.lit("table" if tables.is_table(spark, full) else "view").alias("table_type"), "size_bytes", "row_count",
            )
        )
        partition, cluster = tables.table_layout(spark, full) if tables.is_table(spark, full) else (None, [])
        field = partition.column_name if partition is not None else None
        columns.append(column_rows(spark, database, name, df.schema, field, cluster))
    if not wanted:
        empty = "table_schema string, shard_name string, table_type string, size_bytes bigint, row_count bigint"
        stats = [spark.createDataFrame([], empty)]
        columns = [column_rows(spark, database, "", spark.createDataFrame([], "a int").schema).limit(0)]
    return tuple(functools.reduce(DataFrame.unionByName, part) for part in (stats, columns))
