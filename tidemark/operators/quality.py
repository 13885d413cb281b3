"""Data tests, contracts, table comparison and freshness. Returned rows are failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError, ContractError
from tidemark.operators.merge import check_comparable, col
from tidemark.operators.partition import literal
from tidemark.operators.schema import rebuild, same_type


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; NULLs do not count."""
    return (
        df.where(col(column).isNotNull())
        .groupBy(col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Values outside the list, with their number of rows."""
    return (
        df.groupBy(col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(~F.col("value_field").isin(list(values)))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, once per child row."""
    parents = parent.select(col(parent_column).alias("to_field")).where("to_field is not null").distinct()
    children = child.where(col(column).isNotNull()).select(col(column).alias("from_field"))
    return children.join(parents, F.col("from_field") == F.col("to_field"), "left_anti")


def singular(failures: DataFrame, error_if: str = "> 0") -> DataFrame:
    """Outcome of a test given as a query of failing rows."""
    n = F.count(F.lit(1))
    return failures.agg(n.alias("failures")).select(
        "failures", F.when(F.expr(f"failures {error_if}"), "fail").otherwise("pass").alias("status")
    )


def _sides(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of both tables with how often each side has them, from one pass over each.

    Both sides are tagged, stacked and grouped once, instead of being subtracted from
    each other twice; repeated rows meet in the map-side aggregate.
    """
    check_comparable(a.schema, columns)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    names = [col(c) for c in columns]
    left = a.select(*names, one.alias("__in_a"), none.alias("__in_b"))
    right = b.select(*names, none.alias("__in_a"), one.alias("__in_b"))
    return left.unionByName(right).groupBy(*names).agg(
        F.sum("__in_a").alias("__in_a"), F.sum("__in_b").alias("__in_b")
    )


def row_differences(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows found on one side only, with the side's name."""
    columns = list(columns or a.columns)
    only_a, only_b = F.col("__in_b") == 0, F.col("__in_a") == 0
    return _sides(a, b, columns).where(only_a | only_b).select(
        *[col(c) for c in columns], F.when(only_a, "a").otherwise("b").alias("only_in")
    )


def relation_diff(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: difference of the row counts and number of distinct rows on one side only."""
    one_sided = (F.col("__in_a") == 0) | (F.col("__in_b") == 0)
    return _sides(a, b, list(columns or a.columns)).agg(
        F.coalesce(F.sum(F.col("__in_a") - F.col("__in_b")), F.lit(0)).alias("row_count_difference"),
        F.count_if(one_sided).alias("num_mismatched"),
    )


def schema_matches(a: DataFrame, b: DataFrame) -> bool:
    """Whether both sides have the same column names and types, order aside."""
    left = {f.name.lower(): f.dataType for f in a.schema.fields}
    right = {f.name.lower(): f.dataType for f in b.schema.fields}
    return left.keys() == right.keys() and all(same_type(t, right[n]) for n, t in left.items())


def equal_rows(actual: DataFrame, rows: Sequence[Any], schema: T.StructType | str) -> DataFrame:
    """Differences between a model's output and expected rows given with their types."""
    expected = actual.sparkSession.createDataFrame(rows, schema)
    names = [f.name for f in expected.schema.fields]
    variants = [f.name for f in expected.schema.fields if isinstance(f.dataType, T.VariantType)]
    if variants:
        as_text = {c: F.to_json(col(c)) for c in variants}
        actual, expected = actual.withColumns(as_text), expected.withColumns(as_text)
    return row_differences(actual, expected, names)


def _same_shape(have: T.DataType, want: T.DataType) -> bool:
    """Equal types, where struct fields may come in any order."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        left = {f.name.lower(): f.dataType for f in have.fields}
        right = {f.name.lower(): f.dataType for f in want.fields}
        return left.keys() == right.keys() and all(_same_shape(left[k], right[k]) for k in left)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return _same_shape(have.elementType, want.elementType)
    return same_type(have, want)


def _nested_value(df: DataFrame, path: str) -> Column:
    parts = path.split(".")
    value = col(parts[0])
    for part in parts[1:]:
        value = value.getField(part)
    return value


def enforce_contract(
    df: DataFrame,
    schema: T.StructType | str,
    not_null: Sequence[str] = (),
    *,
    primary_key: Sequence[str] = (),
    foreign_keys: Mapping[str, str] | None = None,
    unsupported: Sequence[str] = (),
) -> DataFrame:
    """``df`` in the declared column order, after its names and types were checked.

    ``not_null`` (dotted paths allowed) is enforced when the plan runs; a required field
    of a NULL struct is not missing. Primary and foreign keys are declarations only.
    ``unique`` and ``check`` constraints cannot be declared.
    """
    if unsupported:
        raise ContractError(f"constraints not supported: {list(unsupported)}")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    have = {f.name.lower(): f for f in df.schema.fields}
    want = {f.name.lower(): f for f in schema.fields}
    problems = [f"{f.name}: missing" for k, f in want.items() if k not in have]
    problems += [f"{f.name}: not declared" for k, f in have.items() if k not in want]
    problems += [
        f"{f.name}: {have[k].dataType.simpleString()} instead of {f.dataType.simpleString()}"
        for k, f in want.items()
        if k in have and not _same_shape(have[k].dataType, f.dataType)
    ]
    declared = set(want)
    problems += [f"{k}: key column not declared" for k in primary_key if k.lower() not in declared]
    problems += [f"{k}: key column not declared" for k in foreign_keys or () if k.lower() not in declared]
    if problems:
        raise ContractError("contract broken: " + "; ".join(problems))
    for path in not_null:
        parent, _, _ = path.rpartition(".")
        value = _nested_value(df, path).isNotNull()
        if parent:
            value = value | _nested_value(df, parent).isNull()
        df = df.where(F.assert_true(value, f"contract: {path} is NULL").isNull())
    return df.select(
        [
            rebuild(col(have[k].name), have[k].dataType, f.dataType).alias(f.name)
            for k, f in want.items()
        ]
    )


def _freshness_row(agg: DataFrame, as_of, warn_after: float | None, error_after: float | None) -> DataFrame:
    as_of = literal(as_of)
    stamp = F.col("max_loaded_at")
    age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(stamp.cast("timestamp"))
    age = (age / F.lit(1_000_000)).cast("double")
    status = F.lit("pass")
    if warn_after is not None:
        status = F.when(age > warn_after, "warn").otherwise(status)
    if error_after is not None:
        status = F.when(age > error_after, "error").otherwise(status)
    return agg.select(
        "source",
        stamp,
        as_of.alias("snapshotted_at"),
        age.alias("age_seconds"),
        F.when(stamp.isNull(), "error").otherwise(status).alias("status"),
    )


def freshness(
    sources: Mapping[str, DataFrame | str],
    as_of,
    *,
    loaded_at: str | Mapping[str, str] | None = None,
    warn_after: float | None = None,
    error_after: float | None = None,
    reject_wildcards: bool = False,
    spark=None,
) -> DataFrame:
    """Age of the newest data of many sources, in one plan.

    With ``loaded_at`` the newest value of that column counts, else the time the newest
    file of the source was written. Thresholds are seconds. A file-based check over a
    path with a wildcard can be rejected.
    """
    parts = []
    for name, source in sources.items():
        column = loaded_at.get(name) if isinstance(loaded_at, Mapping) else loaded_at
        if column is None and reject_wildcards and isinstance(source, str) and "*" in source:
            raise ConfigError(f"{name}: file-based freshness is not supported for a wildcard source")
        df = spark.read.parquet(source) if isinstance(source, str) else source
        if column is not None:
            newest = F.max(col(column)).cast("timestamp_ntz")
        else:
            newest = F.max("_metadata.file_modification_time").cast("timestamp_ntz")
        parts.append(df.agg(newest.alias("max_loaded_at")).withColumn("source", F.lit(name)))
    if not parts:
        raise ConfigError("freshness needs at least one source")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return _freshness_row(stacked, as_of, warn_after, error_after)
