"""Slowly changing dimension snapshots (type 2)."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.merge import (
    HITS,
    all_of,
    check_comparable,
    col,
    differs,
    key_list,
    refuse_repeats,
    repeated_keys,
)
from tidemark.operators.partition import literal
from tidemark.operators.schema import bare_type, conform, evolved_schema

HARD_DELETES = ("ignore", "invalidate", "new_record")


@dataclasses.dataclass(frozen=True)
class SnapshotColumns:
    """Names of the columns a snapshot adds to its source."""

    row_id: str = "row_id"
    updated_at: str = "updated_at_version"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_deleted: str = "is_deleted"


def hash_arguments(*values: Column) -> Column:
    """Hex MD5 of the values as text, NULL as empty text, joined with a pipe."""
    return F.md5(F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("")) for v in values]))


def _first_versions(rows: DataFrame, source_columns, keys, version: Column, names, mark_deleted, kind) -> DataFrame:
    return rows.select(
        *[col(c) for c in source_columns],
        hash_arguments(*[col(k) for k in keys], version).alias(names.row_id),
        version.alias(names.updated_at),
        version.alias(names.valid_from),
        F.lit(None).cast(kind).alias(names.valid_to),
        *([F.lit("False").alias(names.is_deleted)] if mark_deleted else []),
    )


def snapshot(
    current: DataFrame | None,
    source: DataFrame,
    unique_key: str | Sequence[str],
    *,
    strategy: str = "timestamp",
    updated_at: str | None = None,
    check_cols: Sequence[str] | str | None = None,
    hard_deletes: str = "ignore",
    now=None,
    columns: SnapshotColumns = SnapshotColumns(),
) -> DataFrame:
    """The snapshot table after one more run over ``source``.

    ``timestamp``: a row is new if its ``updated_at`` is later than the open version's
    start. ``check``: a row is new if any checked column differs, NULLs compared as
    values; ``check_cols="all"`` checks every source column but the key. A new version
    closes the open one at its own start. Keys that vanished stay open (``ignore``), are
    closed at ``now`` (``invalidate``), or are closed and followed by an open marker row
    (``new_record``). Source columns the snapshot lacks are added without opening new
    versions on their own.

    Closed history never takes part in a join. The source must hold one row per key.
    """
    keys = key_list(unique_key)
    if not keys:
        raise ConfigError("snapshot needs a unique_key")
    if strategy not in ("timestamp", "check"):
        raise ConfigError(f"unknown snapshot strategy {strategy!r}")
    if hard_deletes not in HARD_DELETES:
        raise ConfigError(f"unknown hard_deletes {hard_deletes!r}")
    if strategy == "timestamp" and not updated_at:
        raise ConfigError("the timestamp strategy needs updated_at")
    if strategy == "check" and not check_cols:
        raise ConfigError("the check strategy needs check_cols")
    if now is None and (strategy == "check" or hard_deletes != "ignore"):
        raise ConfigError("this snapshot needs the time of the run (now)")

    mark = hard_deletes == "new_record"
    names = columns
    if updated_at:
        kind = source.schema[updated_at].dataType
        version = col(updated_at)
    else:
        kind = current.schema[names.valid_from].dataType if current is not None else "timestamp_ntz"
        version = literal(now).cast(kind)
    if current is None:
        return _first_versions(source, source.columns, keys, version, names, mark, kind)

    # columns and nested fields new in the source are NULL in old versions
    meta = [names.row_id, names.updated_at, names.valid_from, names.valid_to]
    kept_meta = meta + ([names.is_deleted] if names.is_deleted in current.columns else [])
    old_columns = [c for c in current.columns if c not in kept_meta]
    grown = current.select(*[col(c) for c in old_columns], *[col(c) for c in kept_meta])
    if mark and names.is_deleted not in current.columns:
        grown = grown.withColumn(names.is_deleted, F.lit("False"))
    before = T.StructType([f for f in grown.schema.fields if f.name in old_columns])
    data = evolved_schema(before, source.schema, "append_new_columns").fields
    schema = data + [f for f in grown.schema.fields if f.name not in old_columns]
    grown = conform(grown, T.StructType(schema))
    data_columns = [f.name for f in data]

    closed = grown.where(col(names.valid_to).isNotNull())
    open_rows = grown.where(col(names.valid_to).isNull())
    has_marker = names.is_deleted in grown.columns

    # the new state with its version time
    incoming = source.withColumn("__version", version)
    usable = incoming.where(all_of([col(k).isNotNull() for k in keys])).withColumn(HITS, F.lit(1))
    on = all_of([col(k, "o") == col(k, "s") for k in keys])
    if strategy == "timestamp":
        changed = col(names.valid_from, "o") < col("__version", "s")
    else:
        checked = [c for c in source.columns if c not in keys] if check_cols == "all" else list(check_cols)
        check_comparable(source.schema, checked)
        comparable = [c for c in checked if c in old_columns]
        changed = F.lit(False) if not comparable else differs(
            [col(c, "s") for c in comparable], [col(c, "o") for c in comparable]
        )
    if has_marker:
        changed = changed | (col(names.is_deleted, "o") == "True")
    seen = F.col(f"s.{HITS}").isNotNull()
    joined = refuse_repeats(
        open_rows.alias("o").join(usable.alias("s"), on, "left"),
        all_of([col(k, "o") == F.col(f"__r{i}") for i, k in enumerate(keys)]),
        repeated_keys(usable, keys),
        seen,
        "snapshot: a key occurs more than once in the source",
    )

    renewed = seen & F.coalesce(changed, F.lit(False))
    gone = ~seen
    if has_marker:
        gone = gone & (F.coalesce(col(names.is_deleted, "o"), F.lit("False")) != "True")
    moment = literal(now).cast(kind)
    end = F.when(renewed, col("__version", "s"))
    if hard_deletes != "ignore":
        end = F.when(gone, moment).otherwise(end)

    # one pass over the open rows: each gives itself, then its new version or its marker
    row_type = bare_type(grown.schema)

    def as_row(values: dict[str, Column]) -> Column:
        parts = [
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in row_type.fields
        ]
        return F.struct(*parts).cast(row_type)

    def version_row(data: dict[str, Column], key: Column, start: Column, deleted: str) -> Column:
        meta = {names.row_id: key, names.updated_at: start, names.valid_from: start}
        if has_marker:
            meta[names.is_deleted] = F.lit(deleted)
        return as_row({**data, **meta})

    version_key = hash_arguments(*[col(k, "s") for k in keys], col("__version", "s"))
    renewal = version_row(
        {c: col(c, "s") for c in source.columns}, version_key, col("__version", "s"), "False"
    )
    rows = [
        as_row({**{c: col(c, "o") for c in grown.columns}, names.valid_to: end}),
        F.when(renewed, renewal),
    ]
    if mark:
        marker_key = hash_arguments(col(names.row_id, "o"), moment)
        marker = version_row({c: col(c, "o") for c in data_columns}, marker_key, moment, "True")
        rows.append(F.when(gone, marker))
    known = joined.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")

    open_keys = open_rows.select([col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    same_key = all_of([col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)])
    opened = _first_versions(
        incoming.join(open_keys, same_key, "left_anti"),
        source.columns, keys, col("__version"), names, has_marker, kind,
    )
    result = closed.unionByName(known).unionByName(opened, allowMissingColumns=True)
    return result.select(grown.columns)
