import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError, ContractError, SchemaChangeError
from tidemark.operators.fanout import fan_out, params_from
from tidemark.operators.overwrite import insert_overwrite
from tidemark.operators.merge import merge
from tidemark.operators.partition import IntRange, PartitionSpec
from tidemark.plans.incremental import (
    BuildConfig,
    batch_windows,
    build_incremental,
    build_parameterised,
    merge_table,
    microbatch,
    overwrite_table,
    recompute_dirty,
)
from tidemark.sources import tables

SCHEMA = "id long, ts timestamp_ntz"
DAY = PartitionSpec("ts", "datetime", "day")


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def stored(spark, name):
    return sorted((tuple(r) for r in tables.read_table(spark, name).collect()), key=str)


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def twice(spark, name, config, first, second):
    build_incremental(spark, name, lambda s, target: first if target is None else second, config)
    assert build_incremental(spark, name, lambda s, target: first if target is None else second, config) == "updated"
    return stored(spark, name)


def test_first_run_then_merge(spark, table):
    first = frame(spark, (1, at(1)), (2, at(1)))
    second = frame(spark, (2, at(1, 5)), (3, at(2)))
    got = twice(spark, table, BuildConfig("merge", unique_key="id"), first, second)
    assert got == ordered(merge(first, second, "id"))


@pytest.mark.parametrize("grain", ["hour", "day", "month", "year"])
@pytest.mark.parametrize("scope", ["source_dates", "all"])
def test_partitioned_merge_equals_the_operator(spark, table, grain, scope):
    spec = PartitionSpec("ts", "datetime", grain)
    first = frame(spark, (1, at(1)), (2, at(1, 3)), (3, at(2, 7)), (4, at(2, 9)), (5, None), (6, at(9)))
    second = frame(spark, (1, at(2, 1)), (3, at(2, 8)), (6, at(2, 2)), (7, at(3)), (8, None), (5, at(9, 4)))
    config = BuildConfig("merge", unique_key="id", partition=spec, partition_scope=scope)
    got = twice(spark, table, config, first, second)
    assert got == ordered(merge(first, second, "id", partition=spec, partition_scope=scope))


def test_merge_that_empties_a_partition(spark, table):
    first = frame(spark, (1, at(1)), (2, at(2)))
    second = frame(spark, (1, at(2)), (3, at(1)))
    got = twice(spark, table, BuildConfig("merge", unique_key="id", partition=DAY), first, second)
    assert got == [(1, at(2)), (2, at(2)), (3, at(1))]
    merge_table(spark, table, frame(spark, (3, at(2)), (9, at(1))).where("id = 3").unionByName(frame(spark, (2, at(1)))), "id")
    assert stored(spark, table) == [(1, at(2)), (2, at(1)), (3, at(2))]


def test_integer_partitioned_merge(spark, table):
    spec = PartitionSpec("id", "int64", range=IntRange(1, 10, 1))
    first = frame(spark, *[(i, at(1)) for i in range(1, 5)])
    second = frame(spark, *[(i, at(2)) for i in range(4, 7)])
    config = BuildConfig("merge", unique_key="id", partition=spec)
    assert twice(spark, table, config, first, second) == [(1, at(1)), (2, at(1)), (3, at(1)), (4, at(2)), (5, at(2)), (6, at(2))]


def test_no_key_appends(spark, table):
    first = frame(spark, (1, at(1)))
    assert len(twice(spark, table, BuildConfig("merge", partition=DAY), first, first)) == 2


@pytest.mark.parametrize("spec", [DAY, PartitionSpec("ts", "datetime", "hour"), PartitionSpec("ts", "datetime", "month")])
@pytest.mark.parametrize("listed", [None, [at(1), at(3)]])
def test_overwrite_equals_the_operator(spark, table, spec, listed):
    first = frame(spark, (1, at(1)), (2, at(2)), (3, at(3)), (4, None))
    second = frame(spark, (10, at(1)), (11, at(2)), (12, None))
    config = BuildConfig("insert_overwrite", partition=spec, partitions=listed)
    assert twice(spark, table, config, first, second) == ordered(insert_overwrite(first, second, spec, partitions=listed))


def test_overwrite_with_copy(spark, table):
    spec = PartitionSpec("ts", "datetime", "day", copy_partitions=True)
    first = frame(spark, (1, at(1)), (2, at(2)), (3, at(3)))
    second = frame(spark, (10, at(1)), (11, at(2)))
    config = BuildConfig("insert_overwrite", partition=spec, partitions=[at(1), at(3)])
    assert twice(spark, table, config, first, second) == [(10, at(1)), (2, at(2))]
    with pytest.raises(ConfigError):
        overwrite_table(spark, table, frame(spark, (1, None)))


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_ingestion_time_partitions(spark, table, kind):
    spec = PartitionSpec("ts", kind, "day", ingestion_time=True)
    first = frame(spark, *[(i, at(1)) for i in range(1, 5)])
    second = frame(spark, (10, at(1)), (20, at(1)), (30, at(2)), (40, at(2)))
    got = twice(spark, table, BuildConfig("insert_overwrite", partition=spec), first, second)
    assert [r[0] for r in got] == [10, 20, 30, 40]
    assert tables.read_table(spark, table).columns == ["id", "_PARTITIONTIME"]


def test_contract_of_a_build(spark, table):
    config = BuildConfig("merge", unique_key="id", contract="ts timestamp_ntz, id bigint", not_null=("id",))
    build_incremental(spark, table, lambda s, t: frame(s, (1, at(1))), config)
    assert tables.read_table(spark, table).columns == ["ts", "id"]
    with pytest.raises(Exception, match="id is NULL"):
        build_incremental(spark, table, lambda s, t: frame(s, (None, at(1))), config)
    with pytest.raises(ContractError):
        build_incremental(spark, table, lambda s, t: frame(s, (1, at(1))).withColumn("more", F.lit(1)), config)
    assert len(stored(spark, table)) == 1


def test_full_refresh_and_views(spark, table):
    config = BuildConfig("merge", unique_key="id")
    build_incremental(spark, table, lambda s, t: frame(s, (1, at(1))), config)
    assert build_incremental(spark, table, lambda s, t: frame(s, (2, at(1))), config, full_refresh=True) == "created"
    assert stored(spark, table) == [(2, at(1))]


@pytest.mark.parametrize(
    "config",
    [
        BuildConfig("upsert"),
        BuildConfig("insert_overwrite"),
        BuildConfig("insert_overwrite", partition=DAY, skip_unchanged=True),
        BuildConfig("merge", unique_key="id", partition=PartitionSpec("ts", copy_partitions=True)),
        BuildConfig("microbatch", event_time="ts", batch_size="day", begin=at(1)),
        BuildConfig("microbatch", partition=DAY, event_time="ts", batch_size="hour", begin=at(1)),
        BuildConfig("microbatch", partition=DAY, batch_size="day"),
    ],
)
def test_invalid_configs(spark, table, config):
    with pytest.raises(ConfigError):
        build_incremental(spark, table, lambda s, t: frame(s, (1, at(1))), config)


@pytest.mark.parametrize("mode", ["ignore", "append_new_columns", "sync_all_columns"])
@pytest.mark.parametrize("partition", [None, DAY])
def test_schema_changes(spark, table, mode, partition):
    first = frame(spark, (1, at(1)), (2, at(1))).withColumn("old", F.lit("o"))
    second = frame(spark, (2, at(1)), (3, at(1))).withColumn("new", F.lit("n"))
    if mode == "ignore":
        second = second.withColumn("old", F.lit("x"))
    config = BuildConfig("merge", unique_key="id", partition=partition, on_schema_change=mode)
    twice(spark, table, config, first, second)
    got = tables.read_table(spark, table)
    expected = {
        "ignore": ({"id", "ts", "old"}, {(1, "o"), (2, "x"), (3, "x")}),
        "append_new_columns": ({"id", "ts", "old", "new"}, {(1, "o", None), (2, "o", "n"), (3, None, "n")}),
        "sync_all_columns": ({"id", "ts", "new"}, {(1, None), (2, "n"), (3, "n")}),
    }[mode]
    assert set(got.columns) == expected[0]
    assert {tuple(r) for r in got.drop("ts").collect()} == expected[1]


def test_schema_change_fails_before_any_write(spark, table):
    config = BuildConfig("merge", unique_key="id", on_schema_change="fail")
    first = frame(spark, (1, at(1)))
    with pytest.raises(SchemaChangeError):
        twice(spark, table, config, first, first.withColumn("new", F.lit(1)))
    assert stored(spark, table) == [(1, at(1))]


def test_struct_fields_grow_in_a_stored_table(spark, table):
    first = spark.sql("SELECT 1 AS id, named_struct('a', 'x') AS payload")
    second = spark.sql("SELECT 2 AS id, named_struct('a', 'y', 'b', 'z') AS payload")
    config = BuildConfig("merge", unique_key="id", on_schema_change="append_new_columns")
    build_incremental(spark, table, lambda s, t: first if t is None else second, config)
    build_incremental(spark, table, lambda s, t: first if t is None else second, config)
    assert sorted((r["id"], tuple(r["payload"])) for r in spark.table(table).collect()) == [(1, ("x", None)), (2, ("y", "z"))]


def test_batch_windows():
    assert batch_windows(at(1, 5), at(3, 1), "day") == [(at(1), at(2)), (at(2), at(3)), (at(3), at(4))]
    assert batch_windows(at(1), at(1), "day") == []
    months = batch_windows(datetime.datetime(2023, 12, 31), at(2), "month")
    assert months == [(datetime.datetime(2023, 12, 1), at(1)), (at(1), datetime.datetime(2024, 2, 1))]
    assert len(batch_windows(at(1, 5), at(1, 8), "hour")) == 3
    assert batch_windows(at(5), at(6), "year") == [(at(1), datetime.datetime(2025, 1, 1))]


@pytest.mark.parametrize("kind, cast", [("datetime", "timestamp_ntz"), ("timestamp", "timestamp"), ("date", "date")])
def test_microbatch_equals_batch_by_batch(spark, kind, cast, rows):
    spec = PartitionSpec("ts", kind, "day")
    source = frame(spark, *[(10 + d, at(d, 12)) for d in range(1, 7)]).withColumn("ts", F.col("ts").cast(cast))
    target = frame(spark, *[(d, at(d, 1)) for d in range(1, 7)]).withColumn("ts", F.col("ts").cast(cast))
    step = target
    for start, stop in batch_windows(at(2, 3), at(4, 1), "day"):
        step = microbatch(step, source, "ts", "day", start, stop, spec)
    at_once = microbatch(target, source, "ts", "day", at(2, 3), at(4, 1), spec)
    assert rows(at_once, "id") == rows(step, "id") == [(1,), (12,), (13,), (14,), (5,), (6,)]


def test_microbatch_build(spark, table):
    events = frame(spark, *[(d, at(d, 12)) for d in range(1, 6)])
    config = BuildConfig("microbatch", partition=DAY, event_time="ts", batch_size="day", begin=at(1))
    build = lambda day: build_incremental(spark, table, lambda s, t: events, config, now=at(day))
    assert build(4) == "created" and len(stored(spark, table)) == 3
    assert build(6) == "updated" and len(stored(spark, table)) == 5


def test_parameterised_overwrite(spark, table):
    rows = frame(spark, *[(d, at(d, 12)) for d in range(1, 6)])

    def model(spark, params):
        return fan_out(rows, params.select("dt"), lambda: (
            (F.trunc("query.ts", "month") == F.trunc(F.to_date("params.dt"), "month"))
            & (F.col("query.ts").cast("date") <= F.to_date("params.dt"))
        ))

    params = params_from(spark, values=[{"dt": "2024-01-02"}, {"dt": "2024-01-02 10:00:00"}, {"dt": "2024-01-04"}])
    config = BuildConfig("insert_overwrite", partition=DAY)
    assert build_parameterised(spark, table, model, params, config, source_param="dt") == "created"
    assert stored(spark, table) == [(2, at(2, 12)), (4, at(4, 12))]
    assert build_parameterised(spark, table, model, params, config, source_param="dt") == "updated"
    assert stored(spark, table) == [(2, at(2, 12)), (4, at(4, 12))]
    assert build_parameterised(spark, table, model, params, config, source_param="dt", full_refresh=True) == "created"
    empty = lambda s, p: model(s, p).limit(0)
    build_parameterised(spark, table, empty, params.limit(1), config, source_param="dt")
    assert len(stored(spark, table)) == 1


def test_parameterised_merge(spark, table):
    rows = spark.range(6).selectExpr("id", "id % 3 AS k")
    config = BuildConfig("merge", unique_key="id", on_schema_change="append_new_columns")
    for i, wanted in enumerate(([0, 1], [1, 2])):
        params = params_from(spark, values=[{"p": k} for k in wanted])
        model = lambda s, p: fan_out(rows, p, {"k": "p"}).drop("p").withColumn(f"run{i}", F.lit(i))  # noqa: B023, E731
        build_parameterised(spark, table, model, params, config)
    got = sorted(tuple(r) for r in spark.table(table).select("id", "run0", "run1").collect())
    assert [r[0] for r in got] == [0, 1, 2, 3, 4, 5] and got[2] == (2, None, 1) and got[0] == (0, 0, None)


@pytest.mark.parametrize(
    "config",
    [
        BuildConfig("insert_overwrite", unique_key="id", partition=DAY),
        BuildConfig("insert_overwrite", partition=PartitionSpec("id", "int64")),
        BuildConfig("insert_overwrite", partition=PartitionSpec("ts", "datetime", copy_partitions=True)),
        BuildConfig("merge", partition=PartitionSpec("ts", "timestamp", ingestion_time=True)),
        BuildConfig("microbatch", partition=DAY, event_time="ts", batch_size="day", begin=at(1)),
    ],
)
def test_invalid_parameterised_builds(spark, table, config):
    params = params_from(spark, values=[{"dt": "2024-01-02"}])
    with pytest.raises(ConfigError):
        build_parameterised(spark, table, lambda s, p: frame(s, (1, at(1))), params, config)


def test_parameterised_build_needs_parameters(spark, table):
    params = params_from(spark, values=[], types={"dt": "string"})
    with pytest.raises(ConfigError, match="at least one"):
        build_parameterised(spark, table, lambda s, p: frame(s), params, BuildConfig("merge", unique_key="id"))


def test_recompute_of_dirty_partitions(spark, table):
    tables.create_table_as(frame(spark, (1, at(1)), (2, at(2)), (3, at(3))), table, DAY)
    source = frame(spark, (11, at(1)), (13, at(3)))
    recompute_dirty(spark, table, source, [])
    assert len(stored(spark, table)) == 3
    recompute_dirty(spark, table, source, ["2024-01-02", "2024-01-03"])
    assert stored(spark, table) == [(1, at(1)), (13, at(3))]
    recompute_dirty(spark, table, source, None)
    assert stored(spark, table) == [(11, at(1)), (13, at(3))]


def test_microbatch_runs_only_new_batches(spark, table):
    config = BuildConfig("microbatch", partition=DAY, event_time="ts", batch_size="day", begin=at(1), lookback=1)
    rows = [(d, at(d, 12)) for d in range(1, 6)]
    model = lambda s, t: frame(s, *rows)
    assert build_incremental(spark, table, model, config, now=at(4)) == "created"
    old = {f for f in spark.table(table).inputFiles() if "2024-01-01" in f or "2024-01-02/" in f}
    assert old
    rows += [(12, at(2, 13)), (13, at(3, 13)), (11, at(1, 13))]  # late data
    assert build_incremental(spark, table, model, config, now=at(5)) == "updated"
    spark.catalog.refreshTable(table)
    assert {f for f in spark.table(table).inputFiles() if "2024-01-01" in f} <= old
    # the newest stored day is the 3rd, and the lookback takes in the 2nd
    assert sorted(r[0] for r in stored(spark, table)) == [1, 2, 3, 4, 12, 13]
    build_incremental(spark, table, model, config, now=at(6), batches=(at(1), at(2)))
    assert sorted(r[0] for r in stored(spark, table)) == [1, 2, 3, 4, 11, 12, 13]
