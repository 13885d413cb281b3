"""Keyed upsert of a source into a target."""

from __future__ import annotations

import dataclasses
import functools
import operator
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.errors import ConfigError
from tidemark.operators.partition import PartitionSpec
from tidemark.operators.sizing import split_by_keys

HITS = "__hits"
REPEATS = "__repeats"


def key_list(unique_key: str | Sequence[str] | None) -> list[str]:
    """Key columns without repeats; an empty key means "no key"."""
    if not unique_key:
        return []
    names = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    return list(dict.fromkeys(n for n in names if n))


def _find(name: str, columns: Sequence[str]) -> str | None:
    return next((c for c in columns if c.lower() == name.lower()), None)


def update_list(
    dest_columns: Sequence[str],
    update_columns: Sequence[str] | None,
    exclude_columns: Sequence[str] | None,
) -> list[str]:
    """Columns a matched row takes from the source."""
    if update_columns and exclude_columns:
        raise ConfigError("pass update_columns or exclude_columns, not both")
    if update_columns:
        return list(update_columns)
    skipped = {c.lower() for c in exclude_columns or ()}
    return [c for c in dest_columns if c.lower() not in skipped]


def compare_list(
    dest_columns: Sequence[str],
    keys: Sequence[str],
    stable_columns: Sequence[str] | None,
    unstable_columns: Sequence[str] | None,
) -> list[str]:
    """Columns that decide whether a matched row changed."""
    if not keys:
        raise ConfigError("skip_unchanged needs a unique_key")
    if stable_columns is not None and unstable_columns is not None:
        raise ConfigError("pass stable_columns or unstable_columns, not both")
    key_names = {k.lower() for k in keys}
    if stable_columns is not None:
        unknown = [c for c in stable_columns if c.lower() not in key_names and not _find(c, dest_columns)]
        if unknown:
            raise ConfigError(f"stable_columns not in the target: {unknown}")
        chosen = [c for c in stable_columns if c.lower() not in key_names]
    else:
        ignored = key_names | {c.lower() for c in unstable_columns or ()}
        chosen = [c for c in dest_columns if c.lower() not in ignored]
    if not chosen:
        raise ConfigError("skip_unchanged has no column left to compare")
    return chosen


def comparable(data_type: T.DataType) -> bool:
    """Whether values of a type can be compared for equality."""
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return comparable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(comparable(f.dataType) for f in data_type.fields)
    return True


def check_comparable(schema: T.StructType, columns: Sequence[str]) -> None:
    bad = [f.name for f in schema.fields if f.name in columns and not comparable(f.dataType)]
    if bad:
        raise ConfigError(f"columns of map or variant type cannot be compared: {bad}")


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe row comparison."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str, qualifier: str | None = None) -> Column:
    return F.col(f"{qualifier}.{quoted(name)}" if qualifier else quoted(name))


def all_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def _sides(predicate: str) -> set[str]:
    """Which of ``dest`` and ``source`` a predicate refers to."""
    found = {s for s in ("dest", "source") if re.search(rf"(?i)\b{s}`?\s*\.", predicate)}
    if not found:
        raise ConfigError(f"qualify the columns of {predicate!r} with dest or source")
    return found


def _align(source: DataFrame, target: DataFrame, dest_columns: Sequence[str]) -> DataFrame:
    """Give the source's columns the names and types of the target's."""
    types = {f.name.lower(): f for f in target.schema.fields}
    out = []
    for field in source.schema.fields:
        goal = types.get(field.name.lower())
        value = col(field.name)
        if goal is not None and goal.dataType != field.dataType:
            value = value.cast(goal.dataType)
        out.append(value.alias(goal.name if goal is not None else field.name))
    missing = [c for c in dest_columns if not _find(c, source.columns)]
    if missing:
        raise ConfigError(f"source lacks columns of the target: {missing}")
    return source.select(out)


def insert_rows(target: DataFrame, rows: DataFrame, dest_columns: Sequence[str]) -> DataFrame:
    """Project source rows to the target's columns; unlisted columns become NULL."""
    listed = {c.lower() for c in dest_columns}
    return rows.select(
        [
            col(f.name) if f.name.lower() in listed else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, as ``__r0``, ``__r1``, ...; only the keys are shuffled, after a partial count."""
    grouped = df.groupBy(*[col(k).alias(f"__r{i}") for i, k in enumerate(keys)])
    return grouped.agg(F.count(F.lit(1)).alias(REPEATS)).where(F.col(REPEATS) > 1)


def refuse_repeats(joined: DataFrame, on: Column, repeated: DataFrame, matched: Column, message: str) -> DataFrame:
    """``joined`` as it is; a matched row whose key is in ``repeated`` raises an error when the plan runs."""
    unique = F.assert_true(~matched | F.col(REPEATS).isNull(), message).isNull()
    return joined.join(repeated, on, "left").where(unique)


def merge(
    target: DataFrame,
    source: DataFrame,
    unique_key: str | Sequence[str] | None = None,
    *,
    dest_columns: Sequence[str] | None = None,
    update_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    skip_unchanged: bool = False,
    stable_columns: Sequence[str] | None = None,
    unstable_columns: Sequence[str] | None = None,
    predicates: Sequence[str] = (),
    null_safe: bool = False,
    partition: PartitionSpec | None = None,
    partition_scope: str = "source_dates",
) -> DataFrame:
    """The target after a MERGE of ``source``: matched rows updated, others inserted.

    ``predicates`` are SQL conditions over ``dest.<column>`` and ``source.<column>``
    that belong to the match: a target row that fails one is not matched, so its
    source twin is inserted. ``null_safe`` matches NULL with NULL for a single key;
    a list of keys always uses plain equality.

    With a time ``partition`` and ``partition_scope="source_dates"`` only target rows
    on a day that occurs in the source can match; all other target rows pass through
    without a shuffle. ``"all"`` matches over the whole target.

    A target row matched by several source rows raises an error when the plan runs.

    Plan: the target is the streamed (left) side of one left outer join with the source,
    repeated source keys are found by a count of the keys alone, and inserts are an anti
    join against the matched keys only. Hot target keys can be split by AQE, a small source
    is broadcast, and no target column beyond the key is read for the insert branch. With a
    predicate over both sides the matches are counted by target row instead, and a source
    row that matches none is inserted.
    """
    keys = key_list(unique_key)
    dest = list(dest_columns or target.columns)
    if partition_scope not in ("source_dates", "all"):
        raise ConfigError(f"unknown partition_scope {partition_scope!r}")
    compare = None
    if skip_unchanged:
        compare = compare_list(dest, keys, stable_columns, unstable_columns)
        check_comparable(target.schema, compare)
    updates = update_list(dest, update_columns, exclude_columns)
    source = _align(source, target, dest)
    if not keys:
        return target.unionByName(insert_rows(target, source, dest))

    scope, kept = target, None
    if partition is not None and partition.is_time and partition_scope == "source_dates":
        days = source.select(partition.date_expr(col(partition.column_name)).alias("day"))
        daily = dataclasses.replace(partition, granularity="day")
        scope, kept = split_by_keys(target, partition.date_expr(), days, daily.span(target))

    null_safe = null_safe and len(keys) == 1 and not isinstance(unique_key, (list, tuple))
    mixed: list[str] = []
    usable = source
    unusable = None
    for predicate in predicates:
        if _sides(predicate) == {"dest"}:
            holds = F.coalesce(F.expr(predicate), F.lit(False))
            failing = scope.alias("dest").where(~holds).select("dest.*")
            kept = failing if kept is None else kept.unionByName(failing)
            scope = scope.alias("dest").where(holds).select("dest.*")
        elif _sides(predicate) == {"source"}:
            holds = F.coalesce(F.expr(predicate), F.lit(False))
            failing = usable.alias("source").where(~holds).select("source.*")
            unusable = failing if unusable is None else unusable.unionByName(failing)
            usable = usable.alias("source").where(holds).select("source.*")
        else:
            mixed.append(predicate)

    def same(left: Column, right: Column) -> Column:
        return left.eqNullSafe(right) if null_safe else left == right

    on = all_of([same(col(k, "dest"), col(k, "source")) for k in keys] + [F.expr(p) for p in mixed])
    marked = usable.withColumn(HITS, F.lit(1))
    matched = F.col(f"source.{HITS}").isNotNull()
    message = "merge: a target row is matched by more than one source row"
    if mixed:
        # which source row matches is known only after the predicate: matches are counted by target row
        scope_rows = scope.withColumn("__row", F.monotonically_increasing_id())
        joined = scope_rows.alias("dest").join(marked.alias("source"), on, "left")
        matches = F.count(F.lit(1)).over(Window.partitionBy(F.col("dest.__row")))
        joined = joined.withColumn("__matches", matches)
        joined = joined.where(F.assert_true(~matched | (F.col("__matches") == 1), message).isNull())
    else:
        joined = scope.alias("dest").join(marked.alias("source"), on, "left")
        twice = repeated_keys(usable if null_safe else usable.where(all_of([col(k).isNotNull() for k in keys])), keys)
        known = all_of([same(col(k, "dest"), F.col(f"__r{i}")) for i, k in enumerate(keys)])
        joined = refuse_repeats(joined, known, twice, matched, message)
    apply = matched
    if compare is not None:
        apply = matched & differs([col(c, "source") for c in compare], [col(c, "dest") for c in compare])
    changed = {c.lower() for c in updates}
    updated = joined.select(
        [
            F.when(apply, col(c, "source")).otherwise(col(c, "dest")).alias(c)
            if c.lower() in changed
            else col(c, "dest").alias(c)
            for c in target.columns
        ]
    )

    if mixed:
        # a source row is new if no target row of its key passes the predicate with it
        new_rows = usable.alias("source").join(scope.alias("dest"), on, "left_anti")
    else:
        found = (
            scope.alias("dest")
            .join(usable.alias("source"), on, "left_semi")
            .select([col(k, "dest").alias(f"__k{i}") for i, k in enumerate(keys)])
            .distinct()
        )
        unmatched_on = all_of([same(col(k), F.col(f"__k{i}")) for i, k in enumerate(keys)])
        new_rows = usable.join(found, unmatched_on, "left_anti")
    if unusable is not None:
        new_rows = new_rows.unionByName(unusable)

    result = updated.unionByName(insert_rows(target, new_rows, dest))
    return result if kept is None else kept.unionByName(result)
