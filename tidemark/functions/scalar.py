"""Portable scalar functions. All of them are built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.snapshot import hash_arguments

MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
}
SUNDAY = "1970-01-04"


def _value(v) -> Column:
    """Plain Python values as literals; text names a column."""
    if isinstance(v, Column):
        return v
    return F.col(v) if isinstance(v, str) else F.lit(v)


def equals(a, b, null_safe: bool = True) -> Column:
    """Equality; with ``null_safe`` two NULLs are equal and the result is never NULL."""
    a, b = _value(a), _value(b)
    return a.eqNullSafe(b) if null_safe else a == b


def type_text(kind: T.DataType) -> str:
    """A type in SQL, with the names of nested fields quoted at every level."""
    if isinstance(kind, T.StructType):
        fields = ("`" + f.name.replace("`", "``") + "`: " + type_text(f.dataType) for f in kind.fields)
        return f"struct<{', '.join(fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{type_text(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{type_text(kind.keyType)}, {type_text(kind.valueType)}>"
    return kind.simpleString()


# arrays

def array_construct(items: Sequence, element_type: str | T.DataType | None = None) -> Column:
    if not items and element_type is None:
        raise ConfigError("an empty array needs an element type")
    made = F.array(*[_value(i) for i in items])
    if element_type is None:
        return made
    kind = element_type if isinstance(element_type, str) else type_text(element_type)
    return made.cast(f"array<{kind}>")


def array_append(array, item) -> Column:
    return F.array_append(_value(array), _value(item))


def array_concat(*arrays) -> Column:
    return F.concat(*[_value(a) for a in arrays])


# dates and times

def current_timestamp() -> Column:
    return F.current_timestamp()


def make_date(year, month, day) -> Column:
    return F.make_date(_value(year), _value(month), _value(day))


def date_trunc(part: str, value) -> Column:
    """Start of the period as an instant; weeks start on Sunday."""
    value = _value(value)
    part = part.lower()
    if part == "week":
        shifted = value.cast("timestamp") + F.expr("INTERVAL 1 DAY")
        return F.date_trunc("week", shifted) - F.expr("INTERVAL 1 DAY")
    return F.date_trunc("week" if part == "isoweek" else part, value)


def dateadd(part: str, n, value) -> Column:
    """``value`` as a zoneless time moved by ``n`` periods; month ends are clipped."""
    return F.timestamp_add(part.upper(), _value(n).cast("int"), _value(value).cast("timestamp_ntz"))


def _floor_div(value: Column, size: int) -> Column:
    """Whole division towards the past, exact for every 64-bit value."""
    return F.call_function("div", value - F.pmod(value, F.lit(size).cast("bigint")), F.lit(size).cast("bigint"))


def datediff(first, second, part: str) -> Column:
    """Number of period boundaries between two times, negative if ``second`` is earlier."""
    first, second = (_value(v).cast("timestamp_ntz") for v in (first, second))
    part = part.lower()
    if part in MICROS:
        def index(v):
            return _floor_div(F.unix_micros(v.cast("timestamp")), MICROS[part])

        if part == "microsecond":
            def index(v):  # noqa: F811 - no division, so no rounding
                return F.unix_micros(v.cast("timestamp"))
    elif part == "day":
        def index(v):
            return F.date_diff(v.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    elif part in ("week", "isoweek"):
        origin = F.date_add(F.lit(SUNDAY).cast("date"), 1 if part == "isoweek" else 0)

        def index(v):
            return _floor_div(F.date_diff(v.cast("date"), origin).cast("bigint"), 7)
    elif part == "month":
        def index(v):
            return (F.year(v) * 12 + F.month(v)).cast("bigint")
    elif part == "quarter":
        def index(v):
            return (F.year(v) * 4 + F.quarter(v)).cast("bigint")
    elif part == "year":
        def index(v):
            return F.year(v).cast("bigint")
    else:
        raise ConfigError(f"unknown date part {part!r}")
    return index(second) - index(first)


def last_day(value, part: str = "month") -> Column:
    part = part.lower()
    if part == "month":
        return F.last_day(_value(value))
    if part not in ("quarter", "year"):
        raise ConfigError(f"last_day of a {part} is not supported")
    start = F.trunc(_value(value), part)
    months = 3 if part == "quarter" else 12
    return F.date_sub(F.add_months(start, months), 1)


def string_as_time(text) -> Column:
    """Text of a run time as an instant."""
    return F.to_timestamp(F.lit(text) if isinstance(text, str) else text)


def timestamp_add(value, n: int = 1, part: str = "hour") -> Column:
    return F.timestamp_add(part.upper(), F.lit(n), _value(value))


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """Numbers 1 to ``upper``."""
    powers_of_two(upper)
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def powers_of_two(upper: int) -> int:
    """Smallest n of at least 1 with ``2 ** n >= upper``."""
    if upper <= 0:
        raise ConfigError("the upper bound must be positive")
    return max(1, (upper - 1).bit_length())


def powers_of_two_of(value) -> Column:
    """As ``powers_of_two`` for a whole-number column."""
    value = _value(value).cast("bigint")
    return F.greatest(F.lit(1), F.length(F.bin(value - 1))).cast("bigint")


def date_spine(spark: SparkSession, part: str, start, end) -> DataFrame:
    """One row per period from ``start`` up to, but not including, ``end``."""
    begin, stop = (F.lit(v).cast("timestamp_ntz") for v in (start, end))
    n = intervals_between(begin, stop, part).cast("int")
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return spark.range(1).select(F.explode(steps).alias("i")).select(
        dateadd(part, F.col("i"), begin).alias(f"date_{part.lower()}")
    )


def intervals_between(start, end, part: str) -> Column:
    return datediff(start, end, part)


# text

def concat(*values) -> Column:
    return F.concat(*[_value(v) for v in values])


def length(value) -> Column:
    return F.char_length(_value(value)).cast("bigint")


def replace(value, old: str, new: str) -> Column:
    return F.replace(_value(value), F.lit(old), F.lit(new))


def hash_text(value) -> Column:
    """Lower-case hex MD5 of the value as text."""
    return F.md5(_value(value).cast("string"))


def position(part: str, value) -> Column:
    """1-based place of ``part`` in ``value``, 0 if absent."""
    return F.instr(_value(value), F.lit(part)).cast("bigint")


def right(value, n: int) -> Column:
    return F.right(_value(value), F.lit(n))


def split_part(value, delimiter: str, n: int) -> Column:
    """Part ``n`` counted from 1, or from the end for negative ``n``; NULL if there is none."""
    literal = "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    parts = F.split(_value(value), literal)
    return F.get(parts, F.lit(n - 1) if n >= 0 else F.size(parts) + F.lit(n))


def string_literal(text: str) -> Column:
    """Text as a literal; it is bound, so quotes need no escaping."""
    return F.lit(text)


def string_add(value, text: str, location: str = "append") -> Column:
    if location == "append":
        return F.concat(_value(value), F.lit(text))
    if location == "prepend":
        return F.concat(F.lit(text), _value(value))
    raise ConfigError(f"location must be append or prepend, not {location!r}")


def regexp_extract(value, pattern: str, group: int = 1) -> Column:
    """A group of the first match; NULL without a match."""
    value = _value(value)
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, group))


def regexp_contains(value, pattern: str) -> Column:
    return _value(value).rlike(pattern)


def json_value(value, path: str) -> Column:
    return F.get_json_object(_value(value), path)


# casts

def safe_cast(value, data_type: str | T.DataType) -> Column:
    """Cast that yields NULL where it fails; arrays are cast element by element."""
    return _value(value).try_cast(data_type)


def cast(value, data_type: str | T.DataType) -> Column:
    return _value(value).cast(data_type)


def bool_to_text(value) -> Column:
    return _value(value).cast("string")


def json_parse(value) -> Column:
    """Text as a variant; NULL where it is not JSON."""
    return F.try_parse_json(_value(value))


snapshot_hash = hash_arguments
