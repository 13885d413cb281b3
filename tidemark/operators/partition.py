"""Partition specifications: how a column value maps to its partition."""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ConfigError

TIME_TYPES = ("date", "timestamp", "datetime")
GRANULARITIES = ("hour", "day", "month", "year")
SPARK_TYPES = {
    "date": "date",
    "timestamp": "timestamp",
    "datetime": "timestamp_ntz",
    "int64": "bigint",
}
INGESTION_TIME = "_PARTITIONTIME"


def literal(value: Any) -> Column:
    """A Python value as a literal.

    A time without a zone stays one: as a plain literal it would be read in the time zone of
    the driver's machine, and comparing it would cast the stored column.
    """
    if isinstance(value, datetime.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return value if isinstance(value, Column) else F.lit(value)


@dataclasses.dataclass(frozen=True)
class IntRange:
    start: int
    end: int
    interval: int


@dataclasses.dataclass(frozen=True)
class PartitionSpec:
    """Partitioning of a table by a time column or by integer ranges.

    ``bucket_expr`` gives the typed start of the partition a value belongs to and
    ``id_expr`` the text form used as physical partition value and in change logs.
    """

    field: str
    data_type: str = "date"
    granularity: str = "day"
    range: IntRange | None = None
    ingestion_time: bool = False
    copy_partitions: bool = False

    def __post_init__(self):
        if self.data_type not in SPARK_TYPES:
            raise ConfigError(f"unknown partition data_type {self.data_type!r}")
        if self.granularity not in GRANULARITIES:
            raise ConfigError(f"unknown partition granularity {self.granularity!r}")
        if self.data_type == "date" and self.granularity == "hour":
            raise ConfigError("a date column cannot be partitioned by hour")

    @classmethod
    def parse(cls, raw: Mapping[str, Any] | PartitionSpec | None) -> PartitionSpec | None:
        """Build a spec from a plain mapping; text values are lower-cased."""
        if raw is None or isinstance(raw, cls):
            return raw
        if not isinstance(raw, Mapping) or "field" not in raw:
            raise ConfigError('partition_by must be a mapping with at least a "field" key')
        known = {f.name for f in dataclasses.fields(cls)}
        unknown = set(raw) - known
        if unknown:
            raise ConfigError(f"unknown partition_by keys: {sorted(unknown)}")
        values = {k: v.lower() if isinstance(v, str) else v for k, v in raw.items()}
        bounds = values.get("range")
        if isinstance(bounds, Mapping):
            values["range"] = IntRange(**{k: int(bounds[k]) for k in ("start", "end", "interval")})
        return cls(**values)

    @property
    def is_time(self) -> bool:
        return self.data_type in TIME_TYPES

    @property
    def truncates(self) -> bool:
        """Whether a value differs from its partition start in general."""
        return self.is_time and (self.data_type, self.granularity) != ("date", "day")

    @property
    def column_name(self) -> str:
        return INGESTION_TIME if self.ingestion_time else self.field

    @property
    def spark_type(self) -> str:
        if self.ingestion_time and self.data_type != "date":
            return "timestamp"
        return SPARK_TYPES[self.data_type]

    def column(self, qualifier: str | None = None) -> Column:
        name = f"`{self.column_name}`"
        return F.col(f"{qualifier}.{name}" if qualifier else name)

    def bucket_expr(self, value: Column | None = None) -> Column:
        """Start of the partition that holds ``value`` (the partition column by default)."""
        value = self.column() if value is None else value
        if not self.is_time:
            if self.range is None or self.range.interval == 1:
                return value  # bare column, so filters on it still reach the scan
            return value - (value - F.lit(self.range.start)) % F.lit(self.range.interval)
        value = value.cast(self.spark_type)
        if not self.truncates:
            return value
        if self.data_type == "date":
            return F.trunc(value, self.granularity)
        if self.granularity == "day":
            return value.cast("date").cast(self.spark_type)
        # date_trunc returns an instant, so a zoneless column is cast back
        return F.date_trunc(self.granularity, value).cast(self.spark_type)

    def id_expr(self, value: Column | None = None) -> Column:
        """Partition id as text: ``yyyy-MM-dd HH:00:00`` by hour, else the start date or number."""
        start = self.bucket_expr(value)
        if not self.is_time:
            return start.cast("bigint").cast("string")
        if self.granularity == "hour":
            return F.date_format(start, "yyyy-MM-dd HH:00:00")
        return start.cast("date").cast("string")

    def date_expr(self, value: Column | None = None) -> Column:
        """Calendar day of a time partition column."""
        return (self.column() if value is None else value).cast(self.spark_type).cast("date")

    def span(self, df: DataFrame) -> Callable[[str, str], Column] | None:
        """Filter on the stored column for all partitions from a first to a last id.

        Plain comparisons with constants, which reach the file scan; only for a time
        column stored in the partition type.
        """
        stored = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        if not self.is_time or stored.get(self.column_name) != self.spark_type:
            return None

        def between(first: str, last: str) -> Column:
            after = F.timestamp_add(self.granularity.upper(), F.lit(1), F.lit(last).cast("timestamp_ntz"))
            column = self.column()
            return (column >= F.lit(first).cast(self.spark_type)) & (column < after.cast(self.spark_type))

        return between

    def literal(self, value: Any) -> Column:
        """A Python value as a literal of the partition type."""
        return literal(value).cast(self.spark_type)

    def with_ingestion_time(self, df):
        """Replace the partition column by the hidden ingestion time column."""
        return df.withColumn(INGESTION_TIME, F.col(f"`{self.field}`").cast("timestamp")).drop(self.field)

    def same_layout(self, other: PartitionSpec | None) -> bool:
        """Whether data laid out for ``other`` can be kept for this spec.

        Time columns compare without regard to case, integer ranges exactly.
        """
        if other is None or self.is_time != other.is_time:
            return False
        if self.ingestion_time != other.ingestion_time:
            return False
        if not self.is_time:
            return self.field == other.field and self.range == other.range
        same_field = self.ingestion_time or self.field.lower() == other.field.lower()
        return same_field and self.granularity == other.granularity
