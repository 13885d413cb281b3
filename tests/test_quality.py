import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators import catalog, quality


def test_generic_tests(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, None), (None, "a")], "id int, v string")
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert quality.not_null(df, "v").count() == 2
    assert rows(quality.accepted_values(df, "v", ["a"])) == [("b", 1)]
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(quality.relationships(df, "id", parent, "id")) == [(2,)]


def test_singular_thresholds(spark, rows):
    df = spark.range(3)
    assert rows(quality.singular(df)) == [(3, "fail")]
    assert rows(quality.singular(df.limit(0))) == [(0, "pass")]
    assert rows(quality.singular(df, "> 5")) == [(3, "pass")]


def test_differences_count_distinct_rows_and_nulls(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "id int, v string")
    assert rows(quality.row_differences(a, b)) == [(2, "x", "a"), (3, "y", "b")]
    assert rows(quality.relation_diff(a, b)) == [(1, 2)]
    assert rows(quality.relation_diff(a, a)) == [(0, 0)]
    assert quality.schema_matches(a, b.select("v", "id"))
    assert not quality.schema_matches(a, b.withColumn("v", F.lit(1)))


def test_model_output_against_typed_rows(spark):
    made = spark.sql(
        "SELECT 1 AS id, array('a', NULL) AS l, named_struct('x', 1, 'y', named_struct('z', 'q')) AS s, "
        "array(named_struct('k', 1)) AS ls, parse_json('{\"a\": 1}') AS j"
    )
    same = made.limit(1)
    schema = "id int, l array<string>, s struct<x: int, y: struct<z: string>>, ls array<struct<k: int>>"
    rows = [(1, ["a", None], (1, ("q",)), [(1,)])]
    assert quality.equal_rows(made.drop("j"), rows, schema).count() == 0
    assert quality.equal_rows(made.drop("j"), [(1, ["a"], (1, ("q",)), [(1,)])], schema).count() == 2
    with pytest.raises(ConfigError):
        quality.row_differences(made, same)


def test_freshness(spark, rows, tmp_path):
    as_of = datetime.datetime(2024, 1, 2)
    ages = {"fresh": 3_600, "warned": 40_000, "old": 90_000}
    sources = {
        n: spark.createDataFrame([(as_of - datetime.timedelta(seconds=s),)], "at timestamp_ntz") for n, s in ages.items()
    }
    sources["empty"] = sources["old"].limit(0)
    got = quality.freshness(
        sources, F.lit(as_of).cast("timestamp_ntz"), loaded_at="at", warn_after=36_000, error_after=86_400
    )
    assert rows(got, "source", "age_seconds", "status") == [
        ("empty", None, "error"), ("fresh", 3600.0, "pass"), ("old", 90000.0, "error"), ("warned", 40000.0, "warn")
    ]
    spark.range(3).write.parquet(f"{tmp_path}/one")
    files = quality.freshness({"one": f"{tmp_path}/one"}, datetime.datetime(2100, 1, 1), spark=spark).first()
    assert files["max_loaded_at"] is not None and files["age_seconds"] > 0
    assert quality.freshness({"any": f"{tmp_path}/*"}, datetime.datetime(2100, 1, 1), spark=spark).count() == 1
    with pytest.raises(ConfigError):
        quality.freshness({"any": f"{tmp_path}/*"}, as_of, spark=spark, reject_wildcards=True)
    with pytest.raises(ConfigError):
        quality.freshness({}, as_of)


def test_catalog_folds_shards(spark, rows):
    tables = spark.createDataFrame(
        [
            ("s", "events_20240101", "table", 10, 1),
            ("s", "events_20240102", "table", 20, 2),
            ("s", "plain", "table", 5, 3),
            ("s", "view_20240101", "view", None, None),
        ],
        "table_schema string, shard_name string, table_type string, size_bytes long, row_count long",
    )
    schema = spark.sql("SELECT 1 AS id, named_struct('a', 2, 'b', 'x') AS s, DATE'2024-01-01' AS d").schema
    columns = catalog.column_rows(spark, "s", "events_20240102", schema, "d", ["id", "s.a"])
    report = catalog.catalog_report(tables, columns)
    shards = report.where("table_name = 'events_*'")
    assert rows(shards, "column_name", "column_index", "column_type") == [
        ("d", 5, "date"), ("id", 1, "int"), ("s", 2, "struct<a:int,b:string>"), ("s.a", 3, "int"), ("s.b", 4, "string")
    ]
    first = shards.first()
    assert (first["shard_count"], first["shard_min"], first["shard_max"]) == (2, "20240101", "20240102")
    assert (first["row_count"], first["size_bytes"], first["partition_column"]) == (3, 30, "d")
    assert first["clustering_columns"] == "id, s.a"
    assert rows(report.where("table_name <> 'events_*'"), "table_name", "column_name", "column_index") == [
        ("plain", "<unknown>", 1), ("view_", "<unknown>", 1)
    ]
