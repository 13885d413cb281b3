"""Checked sizes: what may be broadcast or listed on the driver, and what may not."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stage

#: A key list longer than this is not read by the driver.
MAX_LISTED = 10_000
#: Up to this many keys a list is part of the filter itself.
MAX_INLINED = 64
#: A side larger than either bound is left to a shuffle join.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def listed(df: DataFrame, limit: int = MAX_LISTED) -> list[Row] | None:
    """The rows of ``df`` if there are at most ``limit`` of them, else ``None``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def is_small(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Whether ``df`` stays within both bounds.

    Rows are counted first, and bytes only if there are few; both as partial aggregates, so each
    task hands on one number and no row.
    """
    if df.agg(F.count(F.lit(1))).first()[0] > max_rows:
        return False
    size = F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0))
    return (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast only after counting rows and bytes, never beyond the bounds."""
    return F.broadcast(df) if is_small(df) else df


@dataclasses.dataclass(frozen=True)
class KeySet:
    """Distinct non-NULL keys, evaluated once: as a list while short, else as a stored table."""

    kind: T.DataType
    texts: list[str] | None
    table: DataFrame | None = None


def key_set(keys: DataFrame) -> KeySet:
    """Evaluate the one-column ``keys``; beyond ``MAX_LISTED`` they go to the shared folder."""
    name = keys.columns[0]
    kind = keys.schema[name].dataType
    wanted = keys.where(F.col(name).isNotNull()).distinct()
    # through text, so zoneless times do not pick up the driver's time zone
    rows = listed(wanted.select(F.col(name).cast("string").alias("key")))
    if rows is not None:
        return KeySet(kind, sorted(r["key"] for r in rows))
    return KeySet(kind, None, stage(wanted.select(F.col(name).alias("__key")), "keys"))


def _ends(keys: KeySet) -> tuple[str, str]:
    """Smallest and largest key as text."""
    if keys.texts is not None:
        return keys.texts[0], keys.texts[-1]
    key = F.col("__key").cast("string")
    return tuple(keys.table.agg(F.min(key), F.max(key)).first())


def split_by_keys(
    df: DataFrame,
    key: Column,
    keys: KeySet | DataFrame,
    span: Callable[[str, str], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``key`` is in ``keys``, and all other rows.

    A short list becomes a literal set, which can skip whole partitions, a longer one a
    broadcast join, and one beyond the bound a shuffle join. NULL keys never match.
    ``span`` turns the smallest and largest key into a filter on stored columns, so that
    the first side reads less.
    """
    keys = key_set(keys) if isinstance(keys, DataFrame) else keys
    texts = keys.texts
    if texts is not None and not texts:
        return df.limit(0), df
    near = df
    if span is not None:
        near = df.where(span(*_ends(keys)))
    if texts is not None:
        if len(texts) <= MAX_INLINED:
            hit = key.isin([F.lit(t).cast(keys.kind) for t in texts])
            return near.where(hit), df.where(~F.coalesce(hit, F.lit(False)))
        packed = F.split(F.lit("\x01".join(texts)), "\x01").cast(T.ArrayType(keys.kind))
        match = F.broadcast(df.sparkSession.range(1).select(F.explode(packed).alias("__key")))
    else:
        match = keys.table
    inside = near.withColumn("__key", key).join(match, "__key", "left_semi").drop("__key")
    outside = df.withColumn("__key", key).join(match, "__key", "left_anti").drop("__key")
    return inside, outside
