import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators.partition import IntRange, PartitionSpec
from tidemark.operators.sizing import key_set, listed, split_by_keys
import tidemark.operators.sizing as sizing


def test_parse_lowers_text_and_checks():
    spec = PartitionSpec.parse({"field": "TS", "data_type": "Timestamp", "granularity": "HOUR"})
    assert spec == PartitionSpec("ts", "timestamp", "hour")
    spec = PartitionSpec.parse({"field": "id", "data_type": "int64", "range": {"start": 0, "end": 9, "interval": "2"}})
    assert spec.range == IntRange(0, 9, 2)
    for bad in ({"data_type": "date"}, {"field": "a", "kind": 1}, "a", {"field": "a", "data_type": "text"}):
        with pytest.raises(ConfigError):
            PartitionSpec.parse(bad)
    with pytest.raises(ConfigError):
        PartitionSpec("d", "date", "hour")
    assert PartitionSpec.parse(None) is None


def test_same_layout():
    day = PartitionSpec("ts", "datetime", "day")
    assert day.same_layout(PartitionSpec("TS", "datetime", "day"))
    assert not day.same_layout(PartitionSpec("ts", "datetime", "hour"))
    number = PartitionSpec("Id", "int64", range=IntRange(0, 10, 1))
    assert not number.same_layout(PartitionSpec("id", "int64", range=IntRange(0, 10, 1)))
    assert not day.same_layout(None) and not day.same_layout(number)
    ingest = PartitionSpec("ts", "timestamp", "day", ingestion_time=True)
    assert ingest.same_layout(PartitionSpec("other", "timestamp", "day", ingestion_time=True))


def test_int_buckets_truncate_like_the_sql_operator(spark, rows):
    spec = PartitionSpec("v", "int64", range=IntRange(3, 100, 10))
    df = spark.createDataFrame([(v,) for v in (-8, -7, 2, 3, 12, 13, None)], "v bigint")
    expected = [(None, None)] + [(v, v - int((v - 3) - 10 * int((v - 3) / 10))) for v in (-8, -7, 2, 3, 12, 13)]
    assert rows(df.select("v", spec.bucket_expr())) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])
    bare = PartitionSpec("v", "int64", range=IntRange(3, 100, 1))
    assert "v" == bare.bucket_expr()._jc.toString()


def test_partition_ids(spark, rows):
    df = spark.createDataFrame([(datetime.datetime(2024, 3, 9, 17, 5),)], "ts timestamp_ntz")
    got = {
        g: rows(df.select(PartitionSpec("ts", "datetime", g).id_expr()))[0][0] for g in ("hour", "day", "month", "year")
    }
    assert got == {
        "hour": "2024-03-09 17:00:00",
        "day": "2024-03-09",
        "month": "2024-03-01",
        "year": "2024-01-01",
    }


def test_ingestion_time(spark):
    spec = PartitionSpec("d", "date", "day", ingestion_time=True)
    df = spark.createDataFrame([(1, datetime.date(2024, 1, 2))], "id int, d date")
    wrapped = spec.with_ingestion_time(df)
    assert wrapped.columns == ["id", "_PARTITIONTIME"]
    assert wrapped.select(spec.id_expr()).first()[0] == "2024-01-02"


@pytest.mark.parametrize("bounds", [(64, 10_000), (2, 10_000), (2, 3)])
def test_split_by_keys_is_the_same_for_every_size(spark, rows, monkeypatch, bounds):
    monkeypatch.setattr(sizing, "MAX_INLINED", bounds[0])
    monkeypatch.setattr(sizing, "listed", lambda df: listed(df, bounds[1]))
    days = [datetime.datetime(2024, 1, d, 5) for d in range(1, 11)]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "ts timestamp_ntz")
    spec = PartitionSpec("ts", "datetime", "day")
    wanted = df.where("day(ts) <= 5").select(spec.bucket_expr().alias("b"))
    keys = key_set(wanted)
    assert (keys.texts is None) == (bounds[1] == 3)
    inside, outside = split_by_keys(df, spec.bucket_expr(), keys, spec.span(df))
    assert rows(inside) == [(d,) for d in days[:5]]
    assert rows(outside) == [(None,)] + [(d,) for d in days[5:]]


def test_span_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.sql("SELECT id, timestamp_ntz '2024-01-01' + make_dt_interval(cast(id as int)) ts FROM range(30)").write.parquet(path)
    df = spark.read.parquet(path)
    spec = PartitionSpec("ts", "datetime", "day")
    near = df.where(spec.span(df)("2024-01-03", "2024-01-04"))
    assert near.count() == 2
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00)" in plan and "LessThan(ts,2024-01-05T00:00)" in plan
    assert spec.span(df.withColumn("ts", F.col("ts").cast("string"))) is None
