import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.partition import IntRange, PartitionSpec
from tidemark.sources import tables
from tidemark.sources.loads import after_max_partition, event_time_filter, load, preview, read_shards

DAY = PartitionSpec("ts", "datetime", "day")
SCHEMA = "id long, ts timestamp_ntz"


def moments(spark, *days):
    return spark.createDataFrame(
        [(i, None if d is None else datetime.datetime(2024, 1, d, i % 24)) for i, d in enumerate(days)], SCHEMA
    )


def ids(spark, name):
    return sorted(r["id"] for r in tables.read_table(spark, name).collect())


def test_create_replace_and_layout(spark, table, rows):
    tables.create_table_as(moments(spark, 1, 1, 2, None), table, DAY, ["id"])
    assert rows(tables.list_partitions(spark, table)) == [(None,), ("2024-01-01",), ("2024-01-02",)]
    assert tables.table_layout(spark, table) == (DAY, ["id"])
    assert tables.read_table(spark, table).columns == ["id", "ts"]
    assert tables.read_table(spark, table, ["2024-01-01"]).count() == 2
    # the query may read the table it replaces
    tables.create_table_as(tables.read_table(spark, table).where("id > 0"), table, DAY)
    assert ids(spark, table) == [1, 2, 3]
    number = PartitionSpec("id", "int64", range=IntRange(0, 100, 2))
    assert tables.relayout(spark, table, number)
    assert not tables.relayout(spark, table, number)
    assert rows(tables.list_partitions(spark, table)) == [("0",), ("2",)]
    assert ids(spark, table) == [1, 2, 3]


def test_a_failed_replacement_leaves_the_old_table(spark, table):
    tables.create_table_as(spark.range(3), table)
    bad = spark.range(2).select(F.raise_error(F.lit("stop")).cast("int").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.create_table_as(bad, table)
    assert ids(spark, table) == [0, 1, 2]


def test_partition_filter_prunes_folders(spark, table):
    tables.create_table_as(moments(spark, 1, 1, 2), table, DAY)
    plan = tables.read_table(spark, table, ["2024-01-02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan


def test_a_hot_partition_is_written_by_several_tasks(spark, table):
    from tidemark.session import setting

    df = spark.range(0, 60_000, 1, 8).select(
        "id", F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.sha2(F.col("id").cast("string"), 512).alias("pad")
    )
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m"):
        tables.create_table_as(df, table, DAY)
    files = spark.table(table).select(F.input_file_name()).distinct().count()
    assert files > 1


def test_replace_partitions(spark, table):
    tables.create_table_as(moments(spark, 1, 1, 2, 3, None), table, DAY)
    tables.replace_partitions(moments(spark, 2).withColumn("id", F.lit(50)), table, ["2024-01-02", "2024-01-03", "2024-01-09"])
    assert ids(spark, table) == [0, 1, 4, 50]
    with pytest.raises(Exception, match="no partition"):
        tables.replace_partitions(moments(spark, None), table)
    tables.replace_partitions(moments(spark, 2).limit(0), table, ["2024-01-01"])
    assert ids(spark, table) == [4, 50]


def test_too_many_cluster_columns(spark, table):
    with pytest.raises(ConfigError):
        tables.create_table_as(spark.range(1).selectExpr("id", "1 a", "2 b", "3 c", "4 d"), table, cluster_by=list("abcd") + ["id"])


def test_views(spark, table):
    tables.create_table_as(spark.range(3), table)
    with pytest.raises(ConfigError):
        tables.create_view_as(spark.range(1), table)
    tables.create_view_as(spark.range(1), table, full_refresh=True)
    view = table.split(".")[-1]
    assert spark.table(view).count() == 1 and tables.is_view(spark, view)
    with pytest.raises(ConfigError):
        tables.rename_table(spark, view, "t.other")
    tables.clone(spark, view, "t.viewed")
    assert spark.table("viewed").count() == 1


def test_copies(spark, table):
    tables.copy_table(spark.range(2), table, "incremental")
    tables.copy_table(spark.range(3), table, "incremental")
    assert ids(spark, table) == [0, 0, 1, 1, 2]
    tables.copy_table([spark.range(2), spark.range(5, 6)], table)
    assert ids(spark, table) == [0, 1, 5]
    for bad in ((spark.range(1), "merge"), ([], "table")):
        with pytest.raises(ConfigError):
            tables.copy_table(bad[0], table, bad[1])


def test_clone_and_rename_partitioned(spark, table):
    tables.create_table_as(moments(spark, 1, 2, None), table, DAY)
    spark.sql(f"DROP TABLE IF EXISTS {table}_b")
    spark.sql(f"DROP TABLE IF EXISTS {table}_c")
    tables.clone(spark, table, f"{table}_b")
    tables.rename_table(spark, f"{table}_b", f"{table}_c")
    assert ids(spark, f"{table}_c") == [0, 1, 2]
    assert tables.table_layout(spark, f"{table}_c")[0] == DAY
    tables.append_rows(moments(spark, 7), f"{table}_c")
    assert ids(spark, f"{table}_c") == [0, 0, 1, 2] and ids(spark, table) == [0, 1, 2]


def test_add_columns_without_a_rewrite(spark, table):
    tables.create_table_as(moments(spark, 1, 2), table, DAY)
    tables.add_table_columns(spark, table, [T.StructField("note", T.StringType())])
    tables.append_rows(moments(spark, 3).withColumn("note", F.lit("x")), table)
    assert sorted(str(r["note"]) for r in tables.read_table(spark, table).collect()) == ["None", "None", "x"]


def test_python_models(spark, table):
    tables.python_model(spark, lambda s: pd.DataFrame({"a": [1, 2], "b": [["x"], []]}), table)
    assert spark.table(table).count() == 2
    tables.python_model(spark, lambda s: s.range(4).pandas_api(), table, cluster_by=["id"])
    assert ids(spark, table) == [0, 1, 2, 3]
    tables.python_model(spark, lambda s: moments(s, 1, 2), table, DAY)
    assert tables.table_layout(spark, table)[0] == DAY
    with pytest.raises(ConfigError):
        tables.python_model(spark, lambda s: [1], table)


def test_materialized_view(spark, table):
    start = datetime.datetime(2024, 1, 1)
    view = tables.MaterializedView(table, lambda s: s.range(2))
    assert view.refresh(spark, start)
    newer = tables.MaterializedView(table, lambda s: s.range(5))
    assert not newer.refresh(spark, start + datetime.timedelta(minutes=29)) and len(ids(spark, table)) == 2
    assert newer.refresh(spark, start + datetime.timedelta(minutes=29), force=True) and len(ids(spark, table)) == 5
    other = tables.MaterializedView(table, lambda s: s.range(7), PartitionSpec("id", "int64", range=IntRange(0, 10, 5)))
    assert other.refresh(spark, start + datetime.timedelta(minutes=30))
    assert len(ids(spark, table)) == 7


def test_csv_loads(spark, table, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("seed_id|code|flag|day|price|at\n1|007|true|2024-01-02|1.5|2024-01-02 03:04:05\n2|010|false|2024-01-03|2|\n")
    df = load(spark, str(path), "csv", delimiter="|", overrides={"code": "string", "seed_id": "double"})
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds == {"seed_id": "double", "code": "string", "flag": "boolean", "day": "date", "price": "double", "at": "timestamp"}
    assert df.first()["code"] == "007"
    assert load(spark, str(path), "csv", delimiter="|").schema["seed_id"].dataType == T.LongType()
    kept = load(spark, str(path), "csv", delimiter="|", overrides={"flag": "string", "day": "string"}).first()
    assert (kept["flag"], kept["day"]) == ("true", "2024-01-02")
    tables.load_seed(df, table)
    tables.load_seed(df.where("seed_id > 1"), table)
    assert spark.table(table).count() == 1
    tables.load_seed(df.limit(0), table)
    assert spark.table(table).count() == 0 and spark.table(table).columns == df.columns


def test_other_loads(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"id": 1, "at": "2016-09-19 14:45:51"}\n{"id": 2, "at": null}\n')
    df = load(spark, str(tmp_path / "a.ndjson"), "json", overrides={"at": "timestamp"})
    assert df.schema["id"].dataType == T.LongType()
    assert df.agg(F.max("at").cast("string")).first()[0] == "2016-09-19 14:45:51"
    spark.range(2).write.parquet(f"{tmp_path}/p")
    assert load(spark, f"{tmp_path}/p", "parquet", overrides={"id": "string"}).first()["id"] in ("0", "1")
    assert load(spark, f"{tmp_path}/p", "parquet", schema="id int").schema["id"].dataType == T.IntegerType()
    with pytest.raises(ConfigError):
        load(spark, "x", "xml")


def test_shards(spark, tmp_path, rows):
    for day in ("20240101", "20240102", "20240103"):
        spark.range(1).write.parquet(f"{tmp_path}/events_{day}")
    spark.range(1).write.parquet(f"{tmp_path}/other")
    assert rows(read_shards(spark, f"{tmp_path}/events_*"), "shard_date") == [("20240101",), ("20240102",), ("20240103",)]
    assert read_shards(spark, f"{tmp_path}/events_*", start="20240102", end="20240102").count() == 1


def test_reads(spark, rows):
    df = moments(spark, 1, 2, 3, None)
    assert rows(event_time_filter(df, "ts", "2024-01-02"), "id") == [(1,), (2,)]
    assert rows(event_time_filter(df, "ts", end="2024-01-02"), "id") == [(0,)]
    assert preview(df, 2, "id").count() == 2
    target = df.where("day(ts) <= 2 OR ts IS NULL")
    assert rows(after_max_partition(df, target, "ts"), "id") == [(1,), (2,)]
    assert rows(after_max_partition(df, target, "ts", inclusive=False), "id") == [(2,)]
    assert after_max_partition(df, df.limit(0), "ts").count() == 0


def test_nested_names_are_quoted(spark, table):
    from tidemark.functions.scalar import type_text

    kind = "struct<`field-with-dash`: int, `a b`: array<struct<`x``y`: map<string, bigint>>>>"
    df = spark.createDataFrame([], f"id int, s {kind}")
    assert spark.createDataFrame([], f"s {type_text(df.schema['s'].dataType)}").schema["s"] == df.schema["s"]
    tables.create_table_as(spark.createDataFrame([(1,)], "id int"), table)
    tables.add_table_columns(spark, table, [df.schema["s"]])
    assert tables.read_table(spark, table).collect()[0]["s"] is None


def test_stored_results_are_removed(spark):
    import os

    from tidemark.session import shared_dir, stage, staging

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with staging(spark):
        assert stage(spark.range(3)).count() == 3
        assert len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) <= before
