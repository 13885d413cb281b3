"""Aggregates that take in changed rows: what is added and removed, instead of all rows of a group.

The state of a group holds what its measures need: rows, counts of values, exact sums, extremes. A change feed
has the columns of the source and ``_change_type``: ``INSERT`` and ``UPDATE_AFTER`` rows are added to their group,
``DELETE`` and ``UPDATE_BEFORE`` rows, with their old values, are taken from it. Counts and sums over integers and
decimals follow from the feed alone. An extreme follows from it unless the feed removes a value that is as low (or
high) as the known one; such a group has to be read again, as has every touched group with a sum over floats, whose
result depends on what was added before.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.changes import CHANGE_TYPE, snapshot_diff
from tidemark.operators.merge import col, key_list

ADDED, REMOVED = ["INSERT", "UPDATE_AFTER"], ["DELETE", "UPDATE_BEFORE"]
ROWS, SIGN, STALE = "__rows", "__sign", "__stale"


@dataclasses.dataclass(frozen=True)
class Measure:
    """``count`` (of rows, or of a column's values), ``sum``, ``avg``, ``min`` or ``max`` of a column."""

    kind: str
    column: str | None = None

    def __post_init__(self):
        if self.kind not in ("count", "sum", "avg", "min", "max"):
            raise ConfigError(f"unknown measure {self.kind!r}")
        if self.column is None and self.kind != "count":
            raise ConfigError(f"{self.kind} needs a column")

    @property
    def extreme(self) -> bool:
        return self.kind in ("min", "max")

    def exact(self, schema: T.StructType) -> bool:
        """Whether removed values can be subtracted."""
        kind = schema[self.column].dataType if self.column else T.LongType()
        return not self.extreme and (self.kind == "count" or isinstance(kind, (T.IntegralType, T.DecimalType)))


def change_images(before: DataFrame, after: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The feed that leads from one state of a table to the next, with the old and the new row of each update.

    Both states hold one row per key; a repeated key raises an error when the plan runs.
    """
    names = key_list(keys)
    columns = after.columns
    old = F.struct(*[col(c) for c in columns])
    side = lambda df: df.select(*[col(k) for k in names], old.alias("__row"))
    # rows of either side are compared whole; a deleted row shows its old values
    changed = snapshot_diff(side(before), side(after), names)
    updated = changed.where(col(CHANGE_TYPE) == "UPDATE").select(*[col(k) for k in names])
    new = changed.select("__row.*", F.when(col(CHANGE_TYPE) == "UPDATE", "UPDATE_AFTER").otherwise(col(CHANGE_TYPE)).alias(CHANGE_TYPE))
    key = F.struct(*[col(k) for k in names])
    former = before.withColumn("__key", key).join(updated.select(key.alias("__key")), "__key", "left_semi")
    return new.unionByName(former.select(*[col(c) for c in columns], F.lit("UPDATE_BEFORE").alias(CHANGE_TYPE)))


def signed(feed: DataFrame) -> DataFrame:
    """The feed with 1 for added and -1 for removed rows; another change type is an error."""
    kind = col(CHANGE_TYPE)
    sign = F.when(kind.isin(ADDED), 1).when(kind.isin(REMOVED), -1).otherwise(
        F.raise_error(F.concat(F.lit("a feed for aggregates has no change type "), F.coalesce(kind, F.lit("NULL"))))
    )
    return feed.withColumn(SIGN, sign)


def _number(measure: Measure, schema: T.StructType) -> Column:
    kind = schema[measure.column].dataType
    wide = T.DecimalType(38, kind.scale if isinstance(kind, T.DecimalType) else 0) if measure.exact(schema) else T.DoubleType()
    return col(measure.column).cast(wide)


def group_state(rows: DataFrame, group_by: Sequence[str], measures: Mapping[str, Measure], *, removed: bool = False) -> DataFrame:
    """State of every group of ``rows``, which have a ``__sign``; ``removed`` adds the extremes of removed rows.

    Partial aggregates: a task hands on one row for each of its groups, however large they are.
    """
    plus = F.col(SIGN) > 0
    aggs = [F.sum(F.col(SIGN).cast("long")).alias(ROWS)]
    for name, m in measures.items():
        if m.column is not None:
            aggs.append(F.coalesce(F.sum(F.when(col(m.column).isNotNull(), F.col(SIGN).cast("long"))), F.lit(0)).alias(f"{name}__n"))
        if m.kind in ("sum", "avg"):
            value = _number(m, rows.schema)
            aggs.append(F.sum(F.when(plus, value).otherwise(-value)).alias(f"{name}__sum"))
        if m.extreme:
            pick = F.min if m.kind == "min" else F.max
            aggs.append(pick(F.when(plus, col(m.column))).alias(f"{name}__end"))
            if removed:
                aggs.append(pick(F.when(~plus, col(m.column))).alias(f"{name}__gone"))
    return rows.groupBy(*[col(g) for g in group_by]).agg(*aggs)


def take_in(
    state: DataFrame, delta: DataFrame, group_by: Sequence[str], measures: Mapping[str, Measure], schema: T.StructType
) -> DataFrame:
    """``state`` after a ``delta`` (``group_state`` of a feed, with ``removed``); ``schema`` is the source's.

    Adds ``__touched``, and ``__stale`` for groups that still have rows and must be read again.
    """
    gone = [f"{name}__gone" for name, m in measures.items() if m.extreme]
    both = state.select(*[c for c in delta.columns if c not in gone]).withColumn("__touched", F.lit(False))
    both = both.unionByName(delta.withColumn("__touched", F.lit(True)), allowMissingColumns=True)
    aggs = [F.sum(ROWS).alias(ROWS), F.bool_or("__touched").alias("__touched")]
    stale = F.lit(False)
    for name, m in measures.items():
        if m.column is not None:
            aggs.append(F.sum(f"{name}__n").alias(f"{name}__n"))
        if m.kind in ("sum", "avg"):
            aggs.append(F.sum(f"{name}__sum").alias(f"{name}__sum"))
            if not m.exact(schema):
                stale = stale | F.col("__touched")
        if m.extreme:
            pick = F.min if m.kind == "min" else F.max
            aggs += [pick(f"{name}__end").alias(f"{name}__end"), pick(f"{name}__gone").alias(f"{name}__gone")]
            end, lost = F.col(f"{name}__end"), F.col(f"{name}__gone")
            stale = stale | F.coalesce(lost <= end if m.kind == "min" else lost >= end, lost.isNotNull())
    folded = both.groupBy(*[col(g) for g in group_by]).agg(*aggs)
    known = F.assert_true(F.col(ROWS) >= 0, "the feed removes rows that the view does not hold").isNull()
    return folded.where(known).withColumn(STALE, stale & (F.col(ROWS) > 0)).drop(*gone)


def measured(state: DataFrame, group_by: Sequence[str], measures: Mapping[str, Measure], schema: T.StructType) -> DataFrame:
    """The measures of every group that has rows, in the types of the plain aggregates over ``schema``."""
    out = [col(g) for g in group_by]
    for name, m in measures.items():
        if m.kind == "count":
            value = F.col(ROWS if m.column is None else f"{name}__n")
        elif m.extreme:
            value = F.col(f"{name}__end")
        else:
            kind, n, total = schema[m.column].dataType, F.col(f"{name}__n"), F.col(f"{name}__sum")
            if isinstance(kind, T.DecimalType):
                wide = T.DecimalType(min(38, kind.precision + 10), kind.scale)
                mean = T.DecimalType(min(38, kind.precision + 4), min(38, kind.scale + 4))
            else:
                wide, mean = (T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()), T.DoubleType()
            if m.kind == "sum":
                value = F.when(n > 0, total.cast(wide))
            else:
                value = F.when(n > 0, (total if isinstance(kind, T.DecimalType) else total.cast("double")) / n).cast(mean)
        out.append(value.alias(name))
    return state.where(F.col(ROWS) > 0).select(*out)
