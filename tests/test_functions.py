import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.functions import aggregate, scalar, udf


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def moment(text):
    return F.lit(text).cast("timestamp_ntz")


def test_equals_truth_table(spark):
    # The nine cases of two nullable numbers.
    cases = [(1, 1, 1), (2, 1, 2), (3, 1, None), (4, 2, 1), (5, 2, 2), (6, 2, None), (7, None, 1), (8, None, 2), (9, None, None)]
    df = spark.createDataFrame(cases, "key_name int, x int, y int")
    same = {r[0] for r in df.where(scalar.equals("x", "y")).select("key_name").collect()}
    assert same == {1, 5, 9}
    assert df.where(scalar.equals("x", "y", null_safe=False)).count() == 2


@pytest.mark.parametrize(
    "part, a, b, expected",
    [
        ("minute", "2024-01-01 23:59:59", "2024-01-02 00:00:01", 1),
        ("hour", "2024-01-01 23:59:59", "2024-01-02 00:00:01", 1),
        ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:01", 1),
        ("day", "2024-01-02 00:00:01", "2024-01-01 23:59:59", -1),
        ("week", "2024-01-06", "2024-01-07", 1),
        ("isoweek", "2024-01-06", "2024-01-07", 0),
        ("isoweek", "2024-01-07", "2024-01-08", 1),
        ("week", "1969-12-27", "1969-12-28", 1),
        ("month", "2024-01-31", "2024-02-01", 1),
        ("quarter", "2023-12-31", "2024-01-01", 1),
        ("year", "2023-12-31 23:59:59", "2024-01-01", 1),
        ("second", "1969-12-31 23:59:59.5", "1970-01-01 00:00:00.4", 1),
        ("millisecond", "2024-01-01", "2024-01-01 00:00:00.0015", 1),
        ("microsecond", "2024-01-01", "2024-01-01 00:00:00.0015", 1500),
    ],
)
def test_datediff_counts_boundaries(spark, part, a, b, expected):
    assert one(spark, scalar.datediff(moment(a), moment(b), part)) == expected


def test_unknown_part():
    with pytest.raises(ConfigError):
        scalar.datediff("a", "b", "decade")


def test_month_end_is_clipped(spark):
    assert one(spark, scalar.dateadd("month", 1, moment("2024-01-31"))) == datetime.datetime(2024, 2, 29)


def test_week_starts_on_sunday(spark):
    got = one(spark, scalar.date_trunc("week", moment("2024-01-10 05:00:00")).cast("string"))
    assert got == "2024-01-07 00:00:00"
    assert one(spark, scalar.date_trunc("week", moment("2024-01-07")).cast("string")) == "2024-01-07 00:00:00"


def test_last_day(spark):
    day = F.lit("2024-02-10").cast("date")
    got = [one(spark, scalar.last_day(day, p).cast("string")) for p in ("month", "quarter", "year")]
    assert got == ["2024-02-29", "2024-03-31", "2024-12-31"]


def test_series_and_spines(spark):
    assert [r[0] for r in scalar.generate_series(spark, 4).orderBy("generated_number").collect()] == [1, 2, 3, 4]
    assert [scalar.powers_of_two(n) for n in (1, 2, 3, 4, 5, 8, 9)] == [1, 1, 2, 2, 3, 3, 4]
    df = spark.range(1, 10).select(scalar.powers_of_two_of("id"))
    assert [r[0] for r in df.collect()] == [scalar.powers_of_two(n) for n in range(1, 10)]
    with pytest.raises(ConfigError):
        scalar.powers_of_two(0)
    days = scalar.date_spine(spark, "day", "2023-09-01", "2023-09-10").collect()
    assert len(days) == 9 and max(days)[0] == datetime.datetime(2023, 9, 9)
    assert scalar.date_spine(spark, "month", "2023-09-01", "2023-09-01").count() == 0
    assert one(spark, scalar.intervals_between(moment("2023-09-01"), moment("2023-09-12"), "day")) == 11


@pytest.mark.parametrize(
    "n, expected", [(1, "a"), (3, "c"), (4, None), (-1, "c"), (-3, "a"), (-4, None), (0, None)]
)
@pytest.mark.parametrize("delimiter", ["|", ".", "\\", "\\E", "$^"])
def test_split_part(spark, n, expected, delimiter):
    assert one(spark, scalar.split_part(F.lit(delimiter.join("abc")), delimiter, n)) == expected


def test_text(spark):
    assert one(spark, scalar.right(F.lit("abc"), 0)) == "" and one(spark, scalar.right(F.lit("abc"), 2)) == "bc"
    assert one(spark, scalar.position("z", F.lit("abc"))) == 0 and one(spark, scalar.position("c", F.lit("abc"))) == 3
    assert one(spark, scalar.hash_text(F.lit(12))) == "c20ad4d76fe97759aa27a0c99bff6710"
    assert one(spark, scalar.string_literal("it's")) == "it's"
    assert one(spark, scalar.regexp_extract(F.lit("abc"), "(z)")) is None
    with pytest.raises(ConfigError):
        scalar.string_add("a", "b", "middle")


def test_arrays(spark):
    assert one(spark, scalar.array_construct([], "bigint")) == []
    with pytest.raises(ConfigError):
        scalar.array_construct([])
    joined = scalar.array_concat(scalar.array_append(scalar.array_construct([1, 2]), 3), F.array(F.lit(4)))
    assert one(spark, joined) == [1, 2, 3, 4]


def test_safe_cast(spark):
    assert one(spark, scalar.safe_cast(F.lit("x"), "int")) is None
    assert one(spark, scalar.safe_cast(F.array(F.lit("1"), F.lit("x")), "array<int>")) == [1, None]
    assert one(spark, scalar.json_parse(F.lit("{"))) is None


def test_snapshot_hash_keeps_places_of_nulls(spark):
    a, b, none = F.lit("a"), F.lit("b"), F.lit(None).cast("string")
    assert one(spark, scalar.snapshot_hash(a, none, b)) != one(spark, scalar.snapshot_hash(a, b, none))


def test_aggregates(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (3, "a"), (0, "b")], "o int, v string")
    got = df.agg(
        aggregate.listagg(F.col("v"), "_", F.col("o")).alias("l"),
        aggregate.array_agg_distinct("v").alias("d"),
        aggregate.bool_or(F.col("v") == "a").alias("b"),
        aggregate.sum_positive(F.col("o") - 1).alias("s"),
    ).first()
    assert tuple(got) == ("b_b_a", ["a", "b"], True, 3.0)
    empty = df.where("v IS NULL").agg(
        aggregate.listagg(F.col("v")).alias("l"), aggregate.array_agg_distinct("v").alias("d")
    ).first()
    assert tuple(empty) == (None, [])


def test_limited_listagg_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "cast(id as string) AS v", "id AS o")
    top = aggregate.listagg_limit(df, ["k"], "v", ["o"], 2, "|")
    assert sorted(tuple(r) for r in top.collect()) == [(0, "0|2"), (1, "1|3")]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_sql_functions(spark):
    udf.create_sql_function(spark, "twice", {"price": ("double", 100)}, "double", "price * 2")
    assert tuple(spark.sql("SELECT twice(4), twice()").first()) == (8.0, 200.0)
    udf.create_sql_function(spark, "greet", {"a": "string", "b": ("string", "it's")}, "string", "concat(a, b)")
    assert spark.sql("SELECT greet('x ')").first()[0] == "x it's"
    with pytest.raises(ConfigError):
        udf.create_sql_function(spark, "bad name", {}, "int", "1")
    with pytest.raises(ConfigError):
        udf.create_sql_function(spark, "f", {"a": ("int", 1), "b": "int"}, "int", "1")


def test_python_functions(spark):
    def double(x: pd.Series) -> pd.Series:
        return x * 2

    made = udf.python_function(double, "bigint", deterministic=False)
    assert [r[0] for r in spark.range(3).select(made("id")).collect()] == [0, 2, 4]
    assert not made.deterministic


def test_masking_and_aggregate_lookup(spark):
    got = [one(spark, udf.mask_pii(F.lit(v))) for v in ("abcd", "ab", "", None)]
    assert got == ["ab**", "ab", "", None]
    total = udf.aggregate_function("biggest", lambda c: F.max(c))
    assert spark.range(5).agg(total("id")).first()[0] == 4
    assert udf.aggregate_function("sum_positive") is aggregate.sum_positive
    with pytest.raises(ConfigError):
        udf.aggregate_function("nothing")
