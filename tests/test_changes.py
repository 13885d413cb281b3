import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators import changes, ledger
from tidemark.operators.partition import PartitionSpec
import tidemark.operators.changes as changes_module


def at(hour, day=1):
    return datetime.datetime(2024, 1, day, hour)


LOG = "full_table_name string, status string, delta_start timestamp_ntz, delta_end timestamp_ntz, partition_ids array<string>"
ASK = "request_id int, full_table_name string, start timestamp_ntz, `end` timestamp_ntz"


def affected(spark, log, start, end, name="a"):
    requests = spark.createDataFrame([(1, name, start, end)], ASK)
    return changes.affected_partitions(spark.createDataFrame(log, LOG), requests).first()["partition_ids"]


def test_affected_partitions_merge(spark):
    ok = ("a", "ok", at(1), at(2), ["p2", "p1"])
    more = ("a", "ok", at(2), at(3), ["p3", "p1"])
    empty = ("a", "ok", at(3), at(4), [])
    whole = ("a", "unpartitioned", at(4), at(5), None)
    failed = ("a", "error", at(1), at(9), None)
    assert affected(spark, [ok, more, empty, failed], at(0), at(9)) == ["p1", "p2", "p3"]
    assert affected(spark, [ok, whole], at(0), at(9)) is None
    assert affected(spark, [ok, whole], at(0), at(4)) == ["p1", "p2"]
    assert affected(spark, [empty], at(0), at(9)) == []
    assert affected(spark, [ok], at(2), at(9)) == []
    assert affected(spark, [ok], at(0), at(1)) == []
    assert affected(spark, [ok], at(0), at(9), "b") == []


def test_initial_row_counts_only_inside_the_window(spark):
    log = [("a", "initial", at(5), at(5), None)]
    assert affected(spark, log, at(4), at(6)) is None
    assert affected(spark, log, at(5), at(6)) == []
    assert affected(spark, log, at(4), at(5)) == []


@pytest.mark.parametrize("small", [True, False])
def test_overlap_join_is_the_same_for_every_size(spark, rows, monkeypatch, small):
    monkeypatch.setattr(changes_module, "broadcast_if_small", lambda df: F.broadcast(df) if small else df.hint("merge"))
    log = [("a", "ok", at(h % 24, 1 + h // 24), at((h + 30) % 24, 1 + (h + 30) // 24), [str(h)]) for h in range(0, 100, 7)]
    asked = [(i, "a", at(i % 24, 1 + i // 24), at((i + 20) % 24, 1 + (i + 20) // 24)) for i in range(0, 100, 9)]
    asked += [(1000, "a", at(5), at(3)), (1001, "b", at(1), at(2))]
    got = changes.overlapping(spark.createDataFrame(log, LOG), spark.createDataFrame(asked, ASK))
    expected = sorted(
        ((a[0], l[2]) for a in asked for l in log if a[1] == l[0] and l[2] < a[3] and l[3] > a[2]), key=str
    )
    assert sorted((tuple(r) for r in got.select("r.request_id", "l.delta_start").collect()), key=str) == expected


def test_dyadic_pieces_make_up_the_window(spark):
    rng = random.Random(5)
    windows = [(first, first + rng.choice([0, 1, 2, 5, 100, 3650]) + rng.randrange(4)) for first in (rng.randrange(-9000, 30000) for _ in range(200))]
    df = spark.createDataFrame(windows, "first int, last int")
    cut = [F.when(made, F.struct(F.lit(level).alias("level"), place.alias("place")))
           for made, level, place in changes.dyadic_pieces(F.col("first"), F.col("last"), 12)]
    for first, last, pieces in df.select("first", "last", F.array_compact(F.array(*cut))).collect():
        days = sorted(d for p in pieces for d in range(p["place"] << p["level"], (p["place"] + 1) << p["level"]))
        assert days == list(range(first, last + 1))
        assert len(pieces) <= max(1, 2 * math.log2(last - first + 1))


@pytest.mark.parametrize("longest", [1, 40, 5000])
def test_overlap_join_against_all_pairs(spark, rows, longest):
    rng = random.Random(longest)

    def window():
        start = datetime.datetime(1965, 1, 1) + datetime.timedelta(days=rng.randrange(6000), hours=rng.randrange(24))
        return start, start + datetime.timedelta(days=rng.choice([0, 1, longest]) * rng.random(), hours=rng.randrange(-2, 30))

    log = [(rng.choice("ab"), str(k), *window(), [str(k)]) for k in range(120)] + [("a", "none", None, None, [])]
    asked = [(k, rng.choice("abc"), *window()) for k in range(80)] + [(99, "a", None, None), (98, None, *window())]
    log += [(a[1], f"same {a[0]}", a[2], a[3], []) for a in asked[:20]]
    got = changes.overlapping(spark.createDataFrame(log, LOG), spark.createDataFrame(asked, ASK))
    found = sorted((r[0], r[1]) for r in got.select("r.request_id", "l.status").collect())
    assert found == sorted(
        (a[0], entry[1]) for a in asked for entry in log
        if a[1] == entry[0] and None not in (a[2], entry[2]) and entry[2] < a[3] and entry[3] > a[2]
    )
    spread = changes._spread(changes._days(spark.createDataFrame(asked[:80], ASK), "start", "end"), 12, 3, True)
    most = spread.groupBy("request_id").count().agg(F.max("count")).first()[0]
    assert most <= 2 * math.log2(5002) + 4


def hourly(spark):
    """A table's log by the hour over 30 days, and requests that last up to 20 days."""
    rng = random.Random(7)
    begin = datetime.datetime(2024, 1, 1)
    hours = [begin + datetime.timedelta(hours=h) for h in range(720)]
    log = [("a", "ok", h, h + datetime.timedelta(hours=1), [f"{h:%m-%d}"]) for h in hours]
    starts = [begin + datetime.timedelta(minutes=rng.randrange(43200)) for _ in range(60)]
    asked = [(k, "a", s, s + datetime.timedelta(minutes=rng.randrange(-60, 28800))) for k, s in enumerate(starts)]
    return log, asked


def test_overlap_join_compares_few_rows_in_vain(spark, monkeypatch):
    log, asked = hourly(spark)
    sides = []
    monkeypatch.setattr(changes_module, "broadcast_if_small", lambda df: df)
    spread = changes._spread
    monkeypatch.setattr(changes_module, "_spread", lambda *a: sides.append(spread(*a)) or sides[-1])
    got = changes.overlapping(spark.createDataFrame(log, LOG), spark.createDataFrame(asked, ASK)).count()
    assert got == sum(1 for a in asked for entry in log if entry[2] < a[3] and entry[3] > a[2])
    compared = sides[0].join(sides[1], ["full_table_name", "meet"]).count()
    assert compared <= got + 6 * len(asked)


def test_ids_meet_by_stretches_not_by_pairs(spark):
    log, asked = hourly(spark)
    left, right = changes._ids_by_stretch(spark.createDataFrame(log, LOG), spark.createDataFrame(asked, ASK))
    pairs = sum(1 for a in asked for entry in log if entry[2] < a[3] and entry[3] > a[2])
    assert left.join(right, ["full_table_name", "meet"]).count() < pairs / 8


@pytest.mark.parametrize("longest", [1, 40, 900])
def test_affected_partitions_against_all_pairs(spark, longest):
    rng = random.Random(longest)

    def window():
        start = datetime.datetime(1968, 1, 1) + datetime.timedelta(days=rng.randrange(1500), hours=rng.randrange(24))
        return start, start + datetime.timedelta(days=rng.choice([0, 1, longest]) * rng.random(), hours=rng.randrange(-3, 30))

    ids = lambda: rng.choice([None, [], ["p"], [f"p{rng.randrange(9)}", None, "q"]] if rng.random() < 0.2 else [[f"p{rng.randrange(30)}"]])
    status = lambda: rng.choice(["ok", "initial", "error"])
    log = [(rng.choice("ab"), status(), *window(), ids()) for _ in range(200)]
    log += [("a", "ok", None, None, ["x"]), ("a", "ok", datetime.datetime(1969, 1, 1), None, None), (None, "ok", *window(), None)]
    asked = [(k % 70, rng.choice("abc"), *window()) for k in range(90)]
    asked += [(99, "a", None, None), (98, None, *window()), (None, "a", *window()), (97, "a", datetime.datetime(1969, 1, 1), None)]
    # windows that touch, that are empty, and that run backwards
    asked += [(200 + k, entry[0], entry[3], entry[3]) for k, entry in enumerate(log[:30])]
    asked += [(300 + k, entry[0], entry[2] - datetime.timedelta(days=2), entry[2]) for k, entry in enumerate(log[:30])]
    asked += [(400 + k, entry[0], entry[3], entry[3] + datetime.timedelta(days=400)) for k, entry in enumerate(log[:30])]

    def hits(key):
        mine = [a for a in asked if key is not None and a[0] == key]
        return [entry[4] for a in mine for entry in log if entry[1] != "error" and a[1] is not None and a[1] == entry[0]
                and None not in (a[2], a[3], entry[2], entry[3]) and entry[2] < a[3] and entry[3] > a[2]]

    def expected(key):
        lists = hits(key)
        return None if None in lists else sorted({i for found in lists for i in found if i is not None})

    got = changes.affected_partitions(spark.createDataFrame(log, LOG), spark.createDataFrame(asked, ASK)).collect()
    assert len(got) == len(asked)
    assert [(r[0], r["partition_ids"]) for r in got if r["partition_ids"] != expected(r[0])] == []


def test_changes_of_an_empty_window(spark):
    feed = spark.createDataFrame(
        [("a", "INSERT", at(1), "p")],
        "full_table_name string, _change_type string, _change_timestamp timestamp_ntz, partition_id string",
    )
    assert changes.changes_agg(feed, at(2), at(2)).count() == 0
    assert changes.changes_agg(feed, at(1), at(2)).first()["rows_insert"] == 1


def feed_of(spark):
    return spark.createDataFrame(
        [
            ("timed", "INSERT", at(3), "2024-01-01"),
            ("timed", "UPDATE", at(4), "2024-01-02"),
            ("timed", "DELETE", at(9), "2024-01-03"),
            ("flat", "INSERT", at(3), None),
        ],
        "full_table_name string, _change_type string, _change_timestamp timestamp_ntz, partition_id string",
    )


REGISTRY = "full_table_name string, partition_type string, partition_granularity string, partition_field string, found boolean, meta_error string, read_error string"


def pooled(spark, registry, marks, **options):
    listing = spark.createDataFrame(registry, REGISTRY)
    checkpoints = spark.createDataFrame(marks, "full_table_name string, delta_end_time timestamp_ntz")
    result = changes.pool(listing, checkpoints, feed_of(spark), at(8), **options)
    return {r["full_table_name"]: r for r in result.collect()}


def test_pool_status(spark):
    timed = ("time", "day", "ts")
    got = pooled(
        spark,
        [
            ("timed", *timed, True, None, None),
            ("timed", "none", None, None, True, None, None),
            ("quiet", *timed, True, None, None),
            ("new", *timed, True, None, None),
            ("flat", "integer", None, "n", True, None, None),
            ("done", *timed, True, None, None),
            ("gone", *timed, False, None, None),
            ("closed", None, None, None, True, "denied", None),
            ("broken", *timed, True, None, "timeout"),
            ("late", *timed, True, None, None),
        ],
        [(n, at(2)) for n in ("timed", "quiet", "flat", "gone", "closed", "broken")] + [("done", at(8)), ("late", at(0))],
        history_start=spark.createDataFrame([("late", at(1))], "full_table_name string, oldest_change timestamp_ntz"),
    )
    assert {n: r["status"] for n, r in got.items()} == {
        "timed": "ok", "quiet": "ok", "new": "initial", "flat": "unpartitioned", "done": "skipped",
        "gone": "not_found", "closed": "error", "broken": "error", "late": "out_of_range",
    }
    timed = got["timed"]
    assert timed["partition_ids"] == ["2024-01-01", "2024-01-02"] and timed["partitions_changed_cnt"] == 2
    assert (timed["rows_changed"], timed["rows_insert"], timed["rows_update"], timed["rows_delete"]) == (2, 1, 1, 0)
    assert (timed["delta_start"], timed["delta_end"]) == (at(2), at(8))
    assert got["quiet"]["partition_ids"] == [] and got["quiet"]["rows_changed"] == 0
    assert got["new"]["partition_ids"] is None and got["new"]["delta_start"] == got["new"]["delta_end"] == at(8)
    assert got["flat"]["partition_ids"] is None and got["flat"]["rows_changed"] is None
    assert got["done"]["delta_start"] == got["done"]["delta_end"] == at(8)
    assert got["gone"]["delta_start"] is None
    assert {n for n, r in got.items() if not r["logged"]} == {"done", "gone", "closed"}
    assert got["broken"]["error"] == "timeout"


def test_stream_pooling_counts_late_rows(spark):
    got = pooled(spark, [("timed", "time", "day", "ts", True, None, None)], [("timed", at(7))], feed_is_delta=True)["timed"]
    assert got["partition_ids"] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert got["delta_start"] == at(3)


def test_partition_kinds():
    assert changes.partition_kind(None) == ("none", None, None)
    assert changes.partition_kind(PartitionSpec("n", "int64")) == ("integer", None, "n")
    assert changes.partition_kind(PartitionSpec("t", "timestamp", "hour")) == ("time", "hour", "t")
    hidden = PartitionSpec("t", "timestamp", "hour", ingestion_time=True)
    assert changes.partition_kind(hidden) == ("ingestion", "hour", "_PARTITIONTIME")


def test_snapshot_diff_rules(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id long, v string")
    after = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "n")], "id long, v string")
    assert rows(changes.snapshot_diff(before, after, "id")) == [(2, None, "UPDATE"), (3, "c", "INSERT")]
    assert rows(changes.snapshot_diff(after, before, "id")) == [(2, "b", "UPDATE"), (3, "c", "DELETE")]
    with pytest.raises(Exception, match="more than once"):
        changes.snapshot_diff(before, after.unionByName(after), "id").collect()


def test_dirty_rows(spark, rows):
    spec = PartitionSpec("ts", "datetime", "day")
    df = spark.createDataFrame([(1, at(1)), (2, at(1, 2)), (3, None)], "id long, ts timestamp_ntz")
    assert changes.dirty_rows(df, spec, None).count() == 3
    assert changes.dirty_rows(df, spec, []).count() == 0
    assert rows(changes.dirty_rows(df, spec, ["2024-01-02"]), "id") == [(2,)]
    newer = df.withColumn("id", F.col("id") + 10)
    assert rows(changes.dirty_recompute(df, newer, spec, ["2024-01-02"]), "id") == [(1,), (12,), (3,)]
    assert rows(changes.dirty_recompute(df, newer, spec, []), "id") == [(1,), (2,), (3,)]
    assert rows(changes.dirty_recompute(df, newer, spec, None), "id") == [(11,), (12,), (13,)]


def test_first_relation_of_a_name_wins():
    one = {"database": "d", "schema": "s", "identifier": "t", "node": 1}
    assert changes.first_per_name([one, {**one, "node": 2}]) == [one]
    with pytest.raises(ConfigError):
        changes.first_per_name([{"database": "d"}])


def test_coverage(spark, rows):
    marks = spark.createDataFrame([("a", at(5))], "full_table_name string, delta_end_time timestamp_ntz")
    asked = spark.createDataFrame([(1, "a", at(1), at(5)), (2, "a", at(1), at(6)), (3, "b", at(1), at(2))], ASK)
    covered = changes.window_coverage(asked, marks)
    assert rows(covered, "request_id", "coverage") == [(1, "complete"), (2, "incomplete"), (3, "incomplete")]
    assert changes.require_covered(covered.where("request_id = 1")).count() == 1
    with pytest.raises(Exception, match="not pooled"):
        changes.require_covered(covered).collect()


def test_ledger_round(spark, rows):
    registry = spark.createDataFrame([], ledger.REGISTRY_SCHEMA)
    names = spark.createDataFrame([("timed",), ("flat",)], "full_table_name string")
    registry = ledger.register(registry, names, at(0))
    assert rows(registry, "full_table_name", "enabled", "schedule_group") == [
        ("flat", True, "default"), ("timed", True, "default")
    ]
    listing = spark.createDataFrame(
        [("timed", "time", "day", "ts", True, None, None), ("flat", "none", None, None, True, None, None)], REGISTRY
    )
    empty = spark.createDataFrame([], ledger.CHECKPOINT_SCHEMA)
    first = changes.pool(listing, ledger.latest_checkpoints(empty), feed_of(spark), at(2))
    marks = ledger.append_checkpoints(empty, ledger.checkpoint_rows(first, at(2), at(2), "run1"))
    second = changes.pool(listing, ledger.latest_checkpoints(marks), feed_of(spark), at(8))
    assert rows(second, "full_table_name", "status") == [("flat", "unpartitioned"), ("timed", "ok")]
    registry = ledger.record_pooling(registry, second, at(8))
    assert rows(registry, "full_table_name", "partition_type", "last_status", "last_pooled_at") == [
        ("flat", "none", "unpartitioned", at(8)), ("timed", "time", "ok", at(8))
    ]
    log = ledger.log_rows(first.unionByName(second), at(8), "run")
    assert log.count() == 4 and log.schema.names == ledger.LOG_SCHEMA.names
    registry = ledger.unregister(registry, names.where("full_table_name = 'flat'"), at(9))
    assert rows(ledger.list_registry(registry, enabled_only=True), "full_table_name") == [("timed",)]
    registry = ledger.register(registry, names.withColumn("schedule_group", F.lit("night")), at(10))
    assert rows(ledger.list_registry(registry, enabled_only=True, schedule_group="night"), "unregistered_at") == [(None,), (None,)]


def test_latest_checkpoint_prefers_finished_runs(spark, rows):
    marks = spark.createDataFrame(
        [("a", None, True, at(9)), ("a", at(2), True, at(1)), ("a", at(1), True, at(2)), ("a", at(5), False, at(7)), ("b", None, True, at(3))],
        "full_table_name string, node_finished_at timestamp_ntz, success boolean, delta_end_time timestamp_ntz",
    )
    assert rows(ledger.latest_checkpoints(marks), "full_table_name", "delta_end_time") == [("a", at(1)), ("b", at(3))]


def test_run_outcomes(spark, rows):
    events = spark.createDataFrame([(1, "warning"), (1, None), (2, "error"), (3, "INFO")], "run_id int, level string")
    results = spark.createDataFrame(
        [(1, "ok", at(3)), (1, "ok", at(2)), (3, "ok", None), (4, "error", at(1)), (4, None, at(2))],
        "run_id int, status string, delta_start timestamp_ntz",
    )
    got = rows(ledger.run_summary(events, results), "run_id", "status", "num_tables", "num_warnings", "num_errors", "watermark_from", "summary")
    assert got == [
        (1, "warning", 2, 1, 0, at(2), "ok=2"),
        (2, "error", 0, 0, 1, None, None),
        (3, "ok", 1, 0, 0, None, "ok=1"),
        (4, "error", 2, 0, 1, at(1), "error=1, unknown=1"),
    ]


@pytest.mark.parametrize("asked, given", [(-3, 1), (0, 1), (7, 7), (900, 500)])
def test_limits_are_clamped(asked, given):
    assert ledger.clamp_limit(asked) == given


def scans(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # plans show whole filters
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "PushedFilters" in line]


def test_pool_reads_only_the_open_window(spark, tmp_path):
    from tidemark.operators.changes import pool

    schema = "full_table_name string, _change_type string, _change_timestamp timestamp_ntz, partition_id string"
    rows = [("a", "INSERT", datetime.datetime(2024, 1, d), f"2024-01-0{d}") for d in range(1, 8)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/feed")
    registry = spark.createDataFrame([("a", "time", "day", "ts")], "full_table_name string, partition_type string, partition_granularity string, partition_field string")
    marks = spark.createDataFrame([("a", datetime.datetime(2024, 1, 3))], "full_table_name string, delta_end_time timestamp_ntz")
    found = pool(registry, marks, spark.read.parquet(f"{tmp_path}/feed"), datetime.datetime(2024, 1, 6))
    feed = [line for line in scans(found) if "_change_timestamp" in line]
    assert feed and all("GreaterThanOrEqual(_change_timestamp" in x and "LessThan(_change_timestamp" in x for x in feed)
    assert found.first()["rows_changed"] == 3


def test_first_of_repeated_tables_counts(spark):
    from tidemark.operators.changes import first_rows

    rows = [("a", k) for k in range(50)] + [("b", 7), ("a", -1)]
    df = spark.createDataFrame(rows, "name string, k int").repartition(1)
    assert sorted(tuple(r) for r in first_rows(spark.createDataFrame(rows, "name string, k int"), "name").collect()) == [("a", 0), ("b", 7)]
    assert first_rows(df, "name").count() == 2


def test_rebuild_reads_only_the_days_asked_for(spark, tmp_path):
    from tidemark.operators.changes import dirty_rows
    from tidemark.operators.partition import PartitionSpec

    day = PartitionSpec("ts", "datetime", "day")
    spark.range(10).selectExpr("id", "timestampadd(DAY, id, TIMESTAMP_NTZ'2024-01-01 05:00:00') AS ts").write.parquet(f"{tmp_path}/s")
    source = spark.read.parquet(f"{tmp_path}/s")
    ids = ["2024-01-03", "2024-01-04"]
    for wanted in (ids, spark.createDataFrame([(i,) for i in ids], "partition_id string")):
        rows = dirty_rows(source, day, wanted)
        assert all("GreaterThanOrEqual(ts" in x and "LessThan(ts" in x for x in scans(rows))
        assert rows.count() == 2
