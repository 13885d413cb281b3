import datetime
import random

import pytest

from tidemark.errors import ConfigError
from tidemark.operators.overwrite import delete_where, insert_overwrite, overwrite_buckets
from tidemark.operators.partition import IntRange, PartitionSpec
from tidemark.sources import tables

D1, D2, D3 = (datetime.datetime(2020, 1, d) for d in (1, 2, 3))
DAY = PartitionSpec("date_time", "datetime", "day")
SCHEMA = "id long, date_time timestamp_ntz"


def first_run(spark):
    return spark.createDataFrame([(i, D1) for i in (1, 2, 3, 4)], SCHEMA)


def second_run(spark):
    return spark.createDataFrame([(10, D1), (20, D1), (30, D2), (40, D2)], SCHEMA)


GOLDEN = [(10, D1), (20, D1), (30, D2), (40, D2)]


def test_dynamic_golden(spark, rows):
    assert rows(insert_overwrite(first_run(spark), second_run(spark), DAY)) == GOLDEN


def test_date_column_golden(spark, rows):
    spec = PartitionSpec("date_day", "date", "day")
    cast = "id", "cast(date_time as date) AS date_day"
    got = insert_overwrite(first_run(spark).selectExpr(*cast), second_run(spark).selectExpr(*cast), spec)
    assert rows(got) == [(i, d.date()) for i, d in GOLDEN]


def test_hour_golden(spark, rows):
    one, two = datetime.datetime(2020, 1, 1, 1), datetime.datetime(2020, 1, 1, 2)
    spec = PartitionSpec("date_time", "datetime", "hour")
    target = spark.createDataFrame([(i, one) for i in (1, 2, 3, 4)], SCHEMA)
    source = spark.createDataFrame([(10, one), (20, one), (30, two), (40, two)], SCHEMA)
    assert rows(insert_overwrite(target, source, spec)) == [(10, one), (20, one), (30, two), (40, two)]


def test_int_range_with_interval_golden(spark, rows):
    spec = PartitionSpec("id_bucket", "int64", range=IntRange(0, 100, 10))
    target = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (9, 15)], "id long, id_bucket long")
    source = spark.createDataFrame([(10, 4), (20, 5), (30, 6)], "id long, id_bucket long")
    assert rows(insert_overwrite(target, source, spec)) == [(10, 4), (20, 5), (30, 6), (9, 15)]


def test_static_keeps_rows_outside_the_list(spark, rows):
    got = insert_overwrite(first_run(spark), second_run(spark), DAY, partitions=[D1, D3])
    assert rows(got) == GOLDEN
    got = insert_overwrite(first_run(spark), second_run(spark), DAY, partitions=["2020-01-02"])
    assert rows(got) == sorted([(i, D1) for i in (1, 2, 3, 4)] + GOLDEN, key=lambda r: str(r[0]))


def test_static_copy_drops_rows_outside_the_list(spark, rows):
    got = insert_overwrite(first_run(spark), second_run(spark), DAY, partitions=[D1], copy=True)
    assert rows(got) == [(10, D1), (20, D1)]
    # a listed partition without source rows is emptied
    got = insert_overwrite(first_run(spark), second_run(spark).where("id > 20"), DAY, partitions=[D1], copy=True)
    assert rows(got) == []


def test_null_partitions_append(spark, rows):
    source = spark.createDataFrame([(9, None)], SCHEMA)
    once = insert_overwrite(first_run(spark), source, DAY)
    twice = insert_overwrite(once, source, DAY)
    assert rows(twice, "id") == [(1,), (2,), (3,), (4,), (9,), (9,)]
    with pytest.raises(Exception, match="no partition"):
        insert_overwrite(first_run(spark), source, DAY, copy=True).collect()


def test_empty_source_changes_nothing(spark):
    assert insert_overwrite(first_run(spark), second_run(spark).limit(0), DAY).count() == 4


def test_needs_a_partition(spark):
    with pytest.raises(ConfigError):
        insert_overwrite(first_run(spark), second_run(spark), None)


def test_parameter_buckets(spark, rows):
    params = spark.createDataFrame([("2020-01-02 13:00:00",), ("2020-01-02",)], "dt string")
    assert rows(overwrite_buckets(first_run(spark), second_run(spark), DAY, params, "dt")) == [
        (1, D1), (2, D1), (3, D1), (30, D2), (4, D1), (40, D2)
    ]
    own = second_run(spark).selectExpr("*", "'2020-01-01' AS dt")
    got = overwrite_buckets(first_run(spark), own, DAY, params, "dt", source_param="dt")
    assert rows(got, "id") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ConfigError):
        overwrite_buckets(first_run(spark), own, PartitionSpec("id", "int64"), params, "dt")


def test_delete_keeps_rows_with_an_unknown_outcome(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id long, n long")
    assert rows(delete_where(df, "n > 3"), "id") == [(2,), (3,)]


@pytest.mark.parametrize("seed", range(4))
def test_random_overwrites_follow_the_model(spark, seed):
    rng = random.Random(seed)

    def some(n):
        return [(rng.randrange(1000), rng.choice([None, D1, D2, D3])) for _ in range(n)]

    target, source = some(20), some(6)
    replaced = {d for _, d in source if d is not None}
    expected = [r for r in target if r[1] not in replaced] + source
    got = insert_overwrite(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), DAY
    )
    order = lambda r: (r[0], str(r[1]))
    assert sorted(map(tuple, got.collect()), key=order) == sorted(expected, key=order)


def test_null_parameters_are_refused(spark, table):
    from tidemark.operators.fanout import check_listed_overwrite, overwrite_params
    from tidemark.plans.incremental import overwrite_table_buckets

    day = PartitionSpec("ts", "datetime", "day")
    rows = spark.createDataFrame([(1, datetime.datetime(2024, 1, 1)), (2, None)], "id int, ts timestamp_ntz")
    tables.create_table_as(rows, table, day)
    params = spark.createDataFrame([(datetime.datetime(2024, 1, 1),), (None,)], "dt timestamp_ntz")
    with pytest.raises(Exception, match="NULL"):
        overwrite_params(params, day).collect()
    with pytest.raises(Exception, match="NULL"):
        overwrite_table_buckets(spark, table, rows, params, "dt")
    with pytest.raises(ConfigError):
        tables.replace_partitions(rows.limit(0), table, [None])
    with pytest.raises(ConfigError):
        check_listed_overwrite([{"dt": None}])
    assert sorted(r[0] for r in tables.read_table(spark, table).collect()) == [1, 2]


@pytest.mark.parametrize("bound", [2, 10_000])
def test_any_number_of_partitions(spark, table, monkeypatch, bound):
    """The same table whether the keys are a list or stored."""
    from tidemark.operators import sizing
    from tidemark.plans.incremental import merge_table, overwrite_table_buckets

    monkeypatch.setattr(sizing, "listed", lambda df, limit=bound, f=sizing.listed: f(df, limit))
    hour = PartitionSpec("ts", "datetime", "hour")
    stamp = "timestampadd(HOUR, id, TIMESTAMP_NTZ'2024-01-01 00:30:00') AS ts"
    tables.create_table_as(spark.range(12).selectExpr("id", stamp, "0 AS v"), table, hour)
    before = set(spark.table(table).inputFiles())
    params = spark.range(8).selectExpr(stamp.replace("AS ts", "AS dt"))
    source = spark.range(0, 12, 2).selectExpr("id", stamp, "1 AS v")
    overwrite_table_buckets(spark, table, source, params, "dt")
    got = sorted((r["id"], r["v"]) for r in tables.read_table(spark, table).collect())
    assert got == [(0, 1), (2, 1), (4, 1), (6, 1), (8, 0), (9, 0), (10, 0), (11, 0)]
    assert len(before & set(spark.table(table).inputFiles())) == 4
    merge_table(spark, table, spark.range(6, 20, 4).selectExpr("id", stamp, "2 AS v"), "id")
    got = sorted((r["id"], r["v"]) for r in tables.read_table(spark, table).collect())
    assert got == [(0, 1), (2, 1), (4, 1), (6, 2), (8, 0), (9, 0), (10, 2), (11, 0), (14, 2), (18, 2)]
