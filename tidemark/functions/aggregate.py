"""Portable aggregate functions and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bool_or(value) -> Column:
    return F.bool_or(value)


def any_value(value) -> Column:
    return F.any_value(value)


def array_agg_distinct(value) -> Column:
    """Sorted distinct non-NULL values; an empty array if there are none."""
    return F.array_sort(F.collect_set(value))


def array_agg_ordered(value: Column, order: Column) -> Column:
    """Non-NULL values in the order of ``order``."""
    entry = F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))
    return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"])


def listagg(value: Column, delimiter: str = ",", order: Column | None = None) -> Column:
    """Non-NULL values joined into one text per group, NULL for none.

    The result is one cell, so it holds the whole group; see ``listagg_limit`` for groups
    without a bound.
    """
    listed = array_agg_ordered(value, value if order is None else order)
    return F.when(F.count(value) > 0, F.array_join(listed.cast("array<string>"), delimiter))


def listagg_limit(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    order: Sequence[str],
    limit: int,
    delimiter: str = ",",
    name: str = "listed",
) -> DataFrame:
    """The first ``limit`` values of each group joined into one text.

    Rows beyond the limit are dropped before the shuffle (the row number filter becomes a
    partial top-k per task), so a group of any size sends at most ``limit`` rows per task.
    """
    top = Window.partitionBy(*by).orderBy(*order, value)
    place = F.row_number().over(top)
    first = df.where(F.col(value).isNotNull()).withColumn("__n", place).where(F.col("__n") <= limit)
    return first.groupBy(*by).agg(listagg(F.col(value), delimiter, F.col("__n")).alias(name))


def sum_positive(value) -> Column:
    """Sum of the positive values, 0 if there are none."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(value > 0, value)), F.lit(0).cast("double"))


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)
