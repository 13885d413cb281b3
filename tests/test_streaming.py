import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.operators.partition import PartitionSpec
from tidemark.sources import tables
from tidemark.streaming import sinks

DAY = PartitionSpec("ts", "datetime", "day")


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def drain(spark, folder, schema, sink, checkpoint):
    stream = spark.readStream.schema(schema).parquet(folder)
    query = sinks.start(stream, sink, checkpoint)
    query.awaitTermination()
    assert query.exception() is None


def test_stream_upsert(spark, table, tmp_path):
    schema = "id long, ts timestamp_ntz, v string"
    folder, mark = f"{tmp_path}/in", f"{tmp_path}/mark"
    tables.create_table_as(spark.createDataFrame([(1, at(1), "old")], schema), table, DAY)
    sink = sinks.merge_sink(table, "id", order_by="v")
    spark.createDataFrame([(1, at(1), "a"), (1, at(1), "b"), (2, at(2), "c")], schema).write.parquet(folder)
    drain(spark, folder, schema, sink, mark)
    spark.createDataFrame([(2, at(2), "d"), (3, at(3), "e")], schema).write.mode("append").parquet(folder)
    drain(spark, folder, schema, sink, mark)
    got = sorted((r["id"], r["v"]) for r in tables.read_table(spark, table).collect())
    assert got == [(1, "b"), (2, "d"), (3, "e")]
    # a batch that is run again changes nothing
    sink(spark.createDataFrame([(2, at(2), "d")], schema), 1)
    assert tables.read_table(spark, table).count() == 3


def test_stream_overwrite(spark, table, tmp_path):
    schema = "id long, ts timestamp_ntz"
    tables.create_table_as(spark.createDataFrame([(1, at(1)), (2, at(2))], schema), table, DAY)
    spark.createDataFrame([(20, at(2)), (30, at(3))], schema).write.parquet(f"{tmp_path}/in")
    drain(spark, f"{tmp_path}/in", schema, sinks.overwrite_sink(table), f"{tmp_path}/mark")
    assert sorted(r["id"] for r in tables.read_table(spark, table).collect()) == [1, 20, 30]


def test_stream_pooling(spark, table, tmp_path):
    log, marks, registry = (f"{table}_{n}" for n in ("log", "marks", "registry"))
    for name in (log, marks, registry):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.create_ledger(spark, log, marks, registry)
    known = spark.createDataFrame([("a", "time", "day", "ts"), ("b", "none", None, None)],
                                  "full_table_name string, partition_type string, partition_granularity string, partition_field string")
    tables.create_table_as(ledger.register(tables.read_table(spark, registry), known, at(1)), registry)
    schema = "full_table_name string, _change_type string, _change_timestamp timestamp_ntz, partition_id string"
    folder, mark = f"{tmp_path}/in", f"{tmp_path}/mark"
    sink = sinks.pooling_sink(log, marks, registry, now=lambda: at(9), stream="s")

    def feed(*rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(folder)
        drain(spark, folder, schema, sink, mark)

    feed(("a", "INSERT", at(1, 5), "2024-01-01"), ("b", "INSERT", at(1, 6), None))
    feed(("a", "UPDATE", at(2, 5), "2024-01-02"), ("a", "DELETE", at(1, 1), "2023-12-31"))
    rows = sorted((tuple(r) for r in tables.read_table(spark, log).select("full_table_name", "status", "partition_ids", "rows_changed").collect()), key=str)
    assert rows == [
        ("a", "initial", None, None),
        ("a", "ok", ["2023-12-31", "2024-01-02"], 2),
        ("b", "initial", None, None),
        ("b", "unpartitioned", None, None),
    ]
    latest = {r["full_table_name"]: r["delta_end_time"] for r in ledger.latest_checkpoints(tables.read_table(spark, marks)).collect()}
    assert latest["a"] == at(2, 5) + datetime.timedelta(microseconds=1)
    assert {r["last_status"] for r in tables.read_table(spark, registry).collect()} == {"ok", "unpartitioned"}
    # the same batch again leaves no second log row
    sink(spark.createDataFrame([("a", "INSERT", at(3), "2024-01-03")], schema), 1)
    assert tables.read_table(spark, log).count() == 4


def test_latest_row_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, None, None)], "id int, v string, n int")
    got = sinks.latest_per_key(df, ["id"], "n")
    assert got.where(F.col("id") == 1).first()["v"] == "b" and got.columns == df.columns


def ledger_tables(spark, table):
    log, marks, registry = (f"{table}_{n}" for n in ("log", "marks", "registry"))
    for name in (log, marks, registry):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.create_ledger(spark, log, marks, registry)
    known = spark.createDataFrame([(n, "time", "day", "ts") for n in "ab"],
                                  "full_table_name string, partition_type string, partition_granularity string, partition_field string")
    tables.create_table_as(ledger.register(tables.read_table(spark, registry), known, at(1)), registry)
    start = spark.createDataFrame([(n, at(1), at(1), True) for n in "ab"],
                                  "full_table_name string, node_finished_at timestamp_ntz, delta_end_time timestamp_ntz, success boolean")
    tables.append_rows(ledger.append_checkpoints(spark.createDataFrame([], ledger.CHECKPOINT_SCHEMA), start), marks)
    return log, marks, registry


FEED = "full_table_name string, _change_type string, _change_timestamp timestamp_ntz, partition_id string"


def test_second_stream_is_pooled_too(spark, table, tmp_path):
    names = ledger_tables(spark, table)
    for k, name in enumerate("ab"):
        folder = f"{tmp_path}/in{k}"
        spark.createDataFrame([(name, "INSERT", at(2, k), "2024-01-02")], FEED).write.parquet(folder)
        drain(spark, folder, FEED, sinks.pooling_sink(*names, now=lambda: at(9)), f"{tmp_path}/mark{k}")
    got = tables.read_table(spark, names[0]).where("rows_changed = 1").select("full_table_name").collect()
    assert sorted(r[0] for r in got) == ["a", "b"]


def test_repeated_batch_completes_what_is_missing(spark, table, monkeypatch):
    log, marks, registry = ledger_tables(spark, table)
    sink = sinks.pooling_sink(log, marks, registry, now=lambda: at(9), stream="s")
    batch = spark.createDataFrame([("a", "INSERT", at(2), "2024-01-02")], FEED)
    before = tables.read_table(spark, marks).count()
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "checkpoint_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sink(batch, 0)
    logged = tables.read_table(spark, log).count()
    assert logged and tables.read_table(spark, marks).count() == before
    sink(batch, 0)
    sink(batch, 0)
    assert tables.read_table(spark, log).count() == logged
    assert tables.read_table(spark, marks).count() == before + 2


def test_overwrite_keeps_a_day_that_spans_batches(spark, table):
    schema = "id long, ts timestamp_ntz"
    make = lambda *ids: spark.createDataFrame([(i, at(1 + i % 2)) for i in ids], schema)
    tables.create_table_as(make(90, 91, 92), table, DAY)
    for kept in ("one", "two"):
        spark.sql(f"DROP TABLE IF EXISTS {table}__{kept}")
    ids = lambda: sorted(r[0] for r in tables.read_table(spark, table).select("id").collect())
    sink = sinks.overwrite_sink(table, "one")
    sink(make(2, 4), 0)
    assert ids() == [2, 4, 91]
    sink(make(6, 3), 1)
    sink(make(6, 3), 1)
    assert ids() == [2, 3, 4, 6]
    sinks.overwrite_sink(table, "two")(make(8), 0)
    assert ids() == [3, 8]


def test_latest_row_with_unknown_order(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 1, "c")], "id int, seen int, v string")
    assert rows(sinks.latest_per_key(df, ["id"], "seen")) == [(1, None, "a"), (2, 1, "c")]
