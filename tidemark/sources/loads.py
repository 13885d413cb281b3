"""File loads, date-shard scans and event-time reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.catalog import SHARD_PATTERN
from tidemark.operators.merge import col
from tidemark.operators.partition import literal

FORMATS = ("csv", "json", "parquet")


def _widen(kind: T.DataType) -> T.DataType:
    """Whole numbers are loaded as 64 bit, fractions as double."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(kind, (T.FloatType, T.DecimalType)):
        return T.DoubleType()
    if isinstance(kind, T.NullType):
        return T.StringType()
    return kind


def _typed(kind: str | T.DataType) -> T.DataType:
    return T.StructType.fromDDL(f"x {kind}")[0].dataType if isinstance(kind, str) else kind


def load(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    *,
    schema: T.StructType | str | None = None,
    overrides: Mapping[str, str | T.DataType] | None = None,
    delimiter: str = ",",
    header: bool = True,
) -> DataFrame:
    """Read CSV, newline-delimited JSON or Parquet files.

    Without a ``schema`` the types are inferred; ``overrides`` names the type of single
    columns, which are then parsed from the text itself, so ``007`` stays ``007`` as text.
    Inference reads the files once more: pass a schema for large loads.
    """
    if fmt not in FORMATS:
        raise ConfigError(f"unknown load format {fmt!r}")
    wanted = {k.lower(): _typed(v) for k, v in (overrides or {}).items()}
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("sep", delimiter).option("header", header)
    if fmt == "parquet":
        df = reader.parquet(path) if isinstance(path, str) else reader.parquet(*path)
        if schema is not None:
            df = _select_as(df, schema)
        return df.withColumns({f: col(f).cast(wanted[f.lower()]) for f in df.columns if f.lower() in wanted})
    if schema is None:
        infer = reader.option("inferSchema", True).option("preferDate", True) if fmt == "csv" else reader
        found = infer.format(fmt).load(path).schema
        schema = T.StructType(
            [
                T.StructField(f.name, wanted.get(f.name.lower(), _widen(f.dataType)), True)
                for f in found.fields
            ]
        )
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return spark.read.format(fmt).options(
        **({"sep": delimiter, "header": str(header).lower()} if fmt == "csv" else {})
    ).schema(schema).load(path)


def _select_as(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select([col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_shards(spark: SparkSession, pattern: str, *, start: str | None = None, end: str | None = None) -> DataFrame:
    """All date shards under a path pattern such as ``.../events_*``, with their date.

    ``shard_date`` is the eight-digit suffix of the shard's folder or file name.
    """
    name = F.regexp_extract("_metadata.file_path", r"([^/]*[0-9]{8})(?:\.parquet)?(?:/[^/]*)?$", 1)
    df = spark.read.parquet(pattern).withColumn("shard_date", F.regexp_extract(name, SHARD_PATTERN, 2))
    if start is not None:
        df = df.where(F.col("shard_date") >= start)
    if end is not None:
        df = df.where(F.col("shard_date") <= end)
    return df


def event_time_filter(df: DataFrame, field: str, start=None, end=None) -> DataFrame:
    """Rows whose event time lies in ``[start, end)``; either side may be open.

    The bounds are cast to the column's type, so the comparison reaches the file scan.
    """
    kind = df.schema[field].dataType
    if start is not None:
        df = df.where(col(field) >= literal(start).cast(kind))
    if end is not None:
        df = df.where(col(field) < literal(end).cast(kind))
    return df


def preview(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """The first rows of a result."""
    return (df.orderBy(order_by) if order_by else df).limit(n)


def schema_only(df: DataFrame) -> DataFrame:
    """No rows, the full schema."""
    return df.limit(0)


def after_max_partition(source: DataFrame, target: DataFrame, field: str, inclusive: bool = True) -> DataFrame:
    """Source rows from the newest non-NULL partition of the target onwards.

    The maximum is one value; it is read first, so the filter is a constant that reaches
    the scan of the source.
    """
    newest = target.where(col(field).isNotNull()).agg(F.max(col(field)).cast("string")).first()[0]
    if newest is None:
        return source.limit(0)
    bound = F.lit(newest).cast(target.schema[field].dataType)
    return source.where(col(field) >= bound if inclusive else col(field) > bound)
