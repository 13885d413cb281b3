"""Hash buckets of a key as a table's physical partitions, and digests of what they hold."""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.merge import check_comparable, col, key_list

#: The bucket of rows whose key has a NULL.
NO_KEY = "null"
#: More buckets than this would burden the catalog; with ``NO_KEY`` there is one more.
MAX_BUCKETS = 10_000
MEASURES = ["row_count", "high_sum", "low_sum", "hash_xor"]


def bucket_count(size_bytes: int, bucket_bytes: int = 512 * 1024 * 1024) -> int:
    """Buckets for a table of a size: a power of two, so that a bucket is at most about ``bucket_bytes``."""
    wanted = max(1, math.ceil(size_bytes / bucket_bytes))
    return min(1 << (wanted - 1).bit_length(), 1 << (MAX_BUCKETS.bit_length() - 1))


@dataclasses.dataclass(frozen=True)
class KeyBuckets:
    """Layout of a table by the hash of its key: equal keys lie in the same bucket.

    Keys are hashed in the table's types. Rows with a NULL in the key have a bucket of their own,
    as they match nothing but, in a null-safe merge, one another.
    """

    keys: tuple[str, ...]
    count: int

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(key_list(self.keys if isinstance(self.keys, str) else list(self.keys))))
        if not self.keys:
            raise ConfigError("hash buckets need a key")
        if not 1 <= self.count <= MAX_BUCKETS:
            raise ConfigError(f"the number of buckets must be 1 to {MAX_BUCKETS}")

    def id_expr(self, schema: T.StructType) -> Column:
        """Bucket id as text."""
        kinds = {f.name.lower(): f.dataType for f in schema.fields}
        values = []
        for key in self.keys:
            value = col(key)
            if isinstance(kinds.get(key.lower()), (T.FloatType, T.DoubleType)):
                value = value + F.lit(0.0)  # the two zeros are equal, so they must hash alike
            values.append(value)
        number = F.pmod(F.xxhash64(*values), F.lit(self.count)).cast("string")
        whole = F.lit(True)
        for key in self.keys:
            whole = whole & col(key).isNotNull()
        return F.when(whole, F.lpad(number, len(str(self.count - 1)), "0")).otherwise(NO_KEY)

    def covers(self, unique_key: str | Sequence[str] | None) -> bool:
        """Whether rows that agree in ``unique_key`` lie in the same bucket."""
        have = {k.lower() for k in key_list(unique_key)}
        return {k.lower() for k in self.keys} <= have


def value_hash(value: Column, kind: T.DataType) -> Column:
    """A hash that is never NULL and tells NULLs, places and nesting apart, unlike a hash over nested values."""
    if isinstance(kind, T.StructType):
        parts = [value_hash(value.getField(f.name), f.dataType) for f in kind.fields]
        inner = F.xxhash64(F.lit(2), *parts)
    elif isinstance(kind, T.ArrayType):
        inner = F.xxhash64(F.lit(3), F.size(value), F.transform(value, lambda v: value_hash(v, kind.elementType)))
    else:
        inner = F.xxhash64(F.lit(4), value)
    return F.when(value.isNull(), F.lit(1).cast("bigint")).otherwise(inner)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A hash of the columns in the order of their names; maps and variants are refused."""
    wanted = sorted(columns or df.columns, key=str.lower)
    check_comparable(df.schema, wanted)
    return F.xxhash64(*[value_hash(col(c), df.schema[c].dataType) for c in wanted])


def digests(df: DataFrame, bucket: Column, columns: Sequence[str]) -> DataFrame:
    """Number of rows, sums of both halves of their hashes, and the xor of the hashes, of each bucket.

    The digest does not depend on the order of rows and tells repeated rows apart. Partial aggregates: a task
    hands on one row for each bucket.
    """
    hashed = df.select(bucket.alias("bucket"), row_hash(df, columns).alias("h"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.shiftright("h", 32)).alias("high_sum"),
        F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low_sum"),
        F.bit_xor("h").alias("hash_xor"),
    )


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets whose digests differ, or that only one side has."""
    a, b = left.alias("a"), right.alias("b")
    same = [F.col(f"a.{m}").eqNullSafe(F.col(f"b.{m}")) for m in MEASURES]
    equal = same[0]
    for one in same[1:]:
        equal = equal & one
    both = a.join(b, F.col("a.bucket") == F.col("b.bucket"), "full_outer")
    return both.where(~equal).select(F.coalesce("a.bucket", "b.bucket").alias("bucket"))
