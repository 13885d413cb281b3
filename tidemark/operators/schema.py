"""Schema comparison and evolution, including nested fields."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaChangeError
from tidemark.operators.merge import col

MODES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


@dataclasses.dataclass(frozen=True)
class SchemaDiff:
    source_not_in_target: list[str]
    target_not_in_source: list[str]
    new_types: dict[str, T.DataType]

    def __bool__(self) -> bool:
        return bool(self.source_not_in_target or self.target_not_in_source or self.new_types)


def bare_type(data_type: T.DataType) -> T.DataType:
    """The type without nullability, so that only names, order and types count."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, bare_type(f.dataType), True) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(bare_type(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(bare_type(data_type.keyType), bare_type(data_type.valueType), True)
    return data_type


def same_type(left: T.DataType, right: T.DataType) -> bool:
    return bare_type(left) == bare_type(right)


def schema_diff(source: T.StructType, target: T.StructType) -> SchemaDiff:
    """Top-level differences; names compare without regard to case."""
    in_source = {f.name.lower(): f for f in source.fields}
    in_target = {f.name.lower(): f for f in target.fields}
    return SchemaDiff(
        [f.name for k, f in in_source.items() if k not in in_target],
        [f.name for k, f in in_target.items() if k not in in_source],
        {
            f.name: in_source[k].dataType
            for k, f in in_target.items()
            if k in in_source and not same_type(in_source[k].dataType, f.dataType)
        },
    )


def leaf_paths(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    """Every field of a schema by dotted path, parents included."""
    out: dict[str, T.DataType] = {}
    for field in schema.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        out[path] = field.dataType
        inner = field.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            out.update(leaf_paths(inner, path))
    return out


def has_struct(data_type: T.DataType) -> bool:
    while isinstance(data_type, T.ArrayType):
        data_type = data_type.elementType
    return isinstance(data_type, T.StructType)


def rebuild(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as type ``want``, matching nested fields by name.

    Fields missing in ``have`` become NULL; a NULL struct stays NULL at every level.
    """
    if same_type(have, want):
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        by_name = {f.name.lower(): f for f in have.fields}
        parts = []
        for field in want.fields:
            old = by_name.get(field.name.lower())
            if old is None:
                part = F.lit(None).cast(bare_type(field.dataType))
            else:
                part = rebuild(value.getField(old.name), old.dataType, field.dataType)
            parts.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts)).cast(bare_type(want))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda item: rebuild(item, have.elementType, want.elementType)).cast(bare_type(want))
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema`` by name: columns added as NULL, dropped, reordered, cast."""
    by_name = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for field in schema.fields:
        old = by_name.get(field.name.lower())
        if old is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            out.append(rebuild(col(old.name), old.dataType, field.dataType).alias(field.name))
    return df.select(out)


def _loses_fields(name: str, old: T.DataType, new: T.DataType) -> list[str]:
    before = set(leaf_paths(T.StructType([T.StructField(name, old)])))
    after = set(leaf_paths(T.StructType([T.StructField(name, new)])))
    return sorted(before - after)


def evolved_schema(target: T.StructType, source: T.StructType, mode: str) -> T.StructType:
    """Schema of the target after a run whose source has schema ``source``.

    A struct column that differs takes the source's definition, field order included;
    losing a nested field that way is an error, since the target's values would be lost.
    """
    if mode not in MODES:
        raise SchemaChangeError(f"unknown on_schema_change mode {mode!r}")
    diff = schema_diff(source, target)
    if mode == "ignore" or not diff:
        return target
    if mode == "fail":
        raise SchemaChangeError(
            "source and target schemas are out of sync: "
            f"source columns not in target {diff.source_not_in_target}, "
            f"target columns not in source {diff.target_not_in_source}, "
            f"new column types { {k: v.simpleString() for k, v in diff.new_types.items()} }"
        )
    fields = []
    for field in target.fields:
        new = diff.new_types.get(field.name)
        if new is not None and has_struct(new):
            lost = _loses_fields(field.name, field.dataType, new)
            if lost:
                raise SchemaChangeError(f"nested fields cannot be removed: {lost}")
            field = T.StructField(field.name, bare_type(new), True)
        elif mode == "sync_all_columns":
            if field.name in diff.target_not_in_source:
                continue
            if new is not None:
                field = T.StructField(field.name, bare_type(new), True)
        fields.append(field)
    added = set(diff.source_not_in_target)
    fields += [T.StructField(f.name, bare_type(f.dataType), True) for f in source.fields if f.name in added]
    return T.StructType(fields)


def evolve(target: DataFrame, source_schema: T.StructType, mode: str) -> DataFrame:
    """The target's rows under the schema the mode calls for."""
    return conform(target, evolved_schema(target.schema, source_schema, mode))


def alter_column_type(df: DataFrame, column: str, data_type: T.DataType | str) -> DataFrame:
    return df.withColumn(column, col(column).cast(data_type))


def add_columns(df: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop top-level columns; nested fields cannot be dropped."""
    nested = [c for c in columns if "." in c and c not in df.columns]
    if nested:
        raise SchemaChangeError(f"nested fields cannot be dropped: {nested}")
    return df.drop(*columns)


def flat_fields(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """Leaves of nested structs as (path, type); arrays count as leaves."""
    out = []
    for field in schema.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            out += flat_fields(field.dataType, path)
        else:
            out.append((path, field.dataType))
    return out


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """One column per leaf, named by its dotted path."""
    out = []
    for path, _ in flat_fields(df.schema):
        value = col(path[0])
        for part in path[1:]:
            value = value.getField(part)
        out.append(value.alias(separator.join(path)))
    return df.select(out)


def nest(df: DataFrame, separator: str = ".", arrays: Sequence[str] = ()) -> DataFrame:
    """Columns ``a.b`` back into struct ``a``, in order of first appearance.

    Parents named in ``arrays`` hold array columns of equal length, zipped into an
    array of structs.
    """
    tree: dict = {}
    for name in df.columns:
        node = tree
        *parents, leaf = name.split(separator)
        for part in parents:
            node = node.setdefault(part, {})
            if not isinstance(node, dict):
                raise SchemaChangeError(f"{name}: a parent is itself a column")
        if leaf in node:
            raise SchemaChangeError(f"{name}: a parent is itself a column")
        node[leaf] = name

    def build(node, path: str) -> Column:
        if not isinstance(node, dict):
            return col(node)
        if path in arrays:
            if any(isinstance(child, dict) for child in node.values()):
                raise SchemaChangeError(f"{path}: an array parent may only hold plain columns")
            zipped = F.arrays_zip(*[col(child).alias(key) for key, child in node.items()])
            names = list(node)
            return F.transform(
                zipped,
                lambda item: F.struct(*[item.getField(n).alias(n) for n in names]),
            )
        return F.struct(
            *[build(child, f"{path}{separator}{key}").alias(key) for key, child in node.items()]
        )

    return df.select([build(node, name).alias(name) for name, node in tree.items()])


def nested_types(columns: Mapping[str, str | None]) -> dict[str, str]:
    """Declared flat columns (``a.b`` -> type) as nested types of their top-level columns.

    A parent declared as ``array`` becomes an array of structs; its own type otherwise
    only marks the struct. Each nested column needs a type.
    """
    tree: dict = {}
    for name, kind in columns.items():
        node = tree
        parts = name.split(".")
        for part in parts:
            node = node.setdefault(part, {"kind": None, "fields": {}})
            last, node = node, node["fields"]
        last["kind"] = kind

    def render(node: dict) -> str:
        if not node["fields"]:
            if not node["kind"]:
                raise SchemaChangeError("a declared column has no data type")
            return node["kind"]
        inner = ", ".join(f"`{k}`: {render(v)}" for k, v in node["fields"].items())
        text = f"struct<{inner}>"
        return f"array<{text}>" if (node["kind"] or "").strip().lower() == "array" else text

    return {name: render(node) for name, node in tree.items()}


def empty_like(spark, columns: Mapping[str, str | None]) -> DataFrame:
    """A DataFrame without rows whose columns are declared; a missing type is an error."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in nested_types(columns).items())
    return spark.createDataFrame([], ddl)
