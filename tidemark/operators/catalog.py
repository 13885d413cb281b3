"""Catalog report over tables, columns and date shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.schema import leaf_paths

# A date shard is a name ending in eight digits.
SHARD_PATTERN = r"^(.+)([0-9]{8})$"
UNKNOWN = "<unknown>"


def shard_base(name: Column) -> Column:
    """Table name without its shard date; a name that is no shard stays."""
    return F.when(name.rlike(SHARD_PATTERN), F.regexp_extract(name, SHARD_PATTERN, 1)).otherwise(name)


def shard_date(name: Column) -> Column:
    return F.when(name.rlike(SHARD_PATTERN), F.regexp_extract(name, SHARD_PATTERN, 2))


def table_shards(tables: DataFrame) -> DataFrame:
    """``tables`` (``table_schema, shard_name, table_type, size_bytes, row_count``) with shard columns."""
    name = F.col("shard_name")
    is_table = F.col("table_type") == "table"
    return tables.withColumns(
        {
            "table_name": shard_base(name),
            "shard_index": shard_date(name),
            "is_table": is_table,
            "is_date_shard": name.rlike(SHARD_PATTERN) & is_table,
        }
    )


def shard_stats(shards: DataFrame) -> DataFrame:
    """Shard range and total size of each table."""
    return shards.groupBy("table_schema", "table_name").agg(
        F.max("shard_name").alias("latest_shard_name"),
        F.min("shard_index").alias("shard_min"),
        F.max("shard_index").alias("shard_max"),
        F.count("shard_index").alias("shard_count"),
        F.sum("size_bytes").alias("size_bytes"),
        F.sum("row_count").alias("row_count"),
    )


def column_index(columns: DataFrame) -> DataFrame:
    """Number nested column paths within their table.

    The window covers the columns of one table's schema, never its rows.
    """
    order = Window.partitionBy("table_schema", "shard_name").orderBy("ordinal_position", "column_name")
    return columns.withColumn("column_index", F.row_number().over(order).cast("bigint"))


def layout_stats(columns: DataFrame) -> DataFrame:
    """Partition column and ordered cluster columns of each table."""
    clustered = F.col("clustering_ordinal_position").isNotNull()
    entry = F.when(clustered, F.struct("clustering_ordinal_position", "column_name"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["column_name"])
    return columns.groupBy("table_schema", "shard_name").agg(
        F.bool_or("is_partitioning_column").alias("is_partitioned"),
        F.max(F.when(F.col("is_partitioning_column"), F.col("column_name"))).alias("partition_column"),
        F.bool_or(clustered).alias("is_clustered"),
        F.when(F.bool_or(clustered), F.array_join(ordered, ", ")).alias("clustering_columns"),
    )


def catalog_report(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per table and column, date shards folded into ``name*``.

    ``columns``: ``table_schema, shard_name, column_name, column_type, ordinal_position,
    is_partitioning_column, clustering_ordinal_position`` and optionally ``column_comment``.
    Columns and layout are those of the latest shard.
    """
    shards = table_shards(tables)
    if "table_comment" not in shards.columns:
        shards = shards.withColumn("table_comment", F.lit(None).cast("string"))
    if "column_comment" not in columns.columns:
        columns = columns.withColumn("column_comment", F.lit(None).cast("string"))
    logical = shards.select(
        "table_schema", "table_name", "is_date_shard", "table_type", "is_table", "table_comment"
    ).distinct()
    stats = shard_stats(shards).withColumnRenamed("latest_shard_name", "shard_name")
    layout = layout_stats(columns)
    numbered = column_index(columns)
    shard_key = ["table_schema", "shard_name"]
    report = (
        logical.join(stats, ["table_schema", "table_name"])
        .join(layout, shard_key, "left")
        .join(numbered, shard_key, "left")
    )
    return report.select(
        "table_schema",
        F.when(F.col("is_date_shard"), F.concat("table_name", F.lit("*")))
        .otherwise(F.col("table_name"))
        .alias("table_name"),
        "table_type",
        "table_comment",
        F.coalesce("column_name", F.lit(UNKNOWN)).alias("column_name"),
        F.coalesce("column_index", F.lit(1).cast("bigint")).alias("column_index"),
        F.coalesce("column_type", F.lit(UNKNOWN)).alias("column_type"),
        F.coalesce("column_comment", F.lit("")).alias("column_comment"),
        "is_date_shard",
        "shard_count",
        "shard_min",
        "shard_max",
        "row_count",
        "size_bytes",
        "is_partitioned",
        "partition_column",
        "is_clustered",
        "clustering_columns",
    )


def column_rows(spark, table_schema: str, name: str, schema: T.StructType, partition_column=None, cluster=()) -> DataFrame:
    """Schema of one table as rows of the ``columns`` input, nested paths included."""
    top = [f.name for f in schema.fields]
    rows = []
    for path, kind in leaf_paths(schema).items():
        root = path.split(".")[0]
        rows.append(
            (
                table_schema,
                name,
                path,
                kind.simpleString(),
                top.index(root) + 1,
                path == partition_column,
                list(cluster).index(path) + 1 if path in cluster else None,
            )
        )
    return spark.createDataFrame(
        rows,
        "table_schema string, shard_name string, column_name string, column_type string, "
        "ordinal_position int, is_partitioning_column boolean, clustering_ordinal_position int",
    )
