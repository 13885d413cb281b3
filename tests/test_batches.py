"""Microbatches that resume after failures and fill holes."""

import datetime

import pytest

from tidemark.errors import ConfigError
from tidemark.operators.partition import PartitionSpec
from tidemark.plans.batches import build_batches, done_batches
from tidemark.plans.incremental import BuildConfig, build_incremental
from tidemark.sources import tables

DAY = PartitionSpec("ts", "datetime", "day")


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def config(lookback=0):
    return BuildConfig("microbatch", partition=DAY, event_time="ts", batch_size="day", begin=at(1), lookback=lookback)


def events(spark, days, version=0):
    return spark.createDataFrame([(d, version, at(d, 12)) for d in days], "id long, version int, ts timestamp_ntz")


def stored(spark, name):
    return sorted((r["id"], r["version"]) for r in tables.read_table(spark, name).collect())


class Model:
    """Fails when it is called for the ``fails``-th time."""

    def __init__(self, rows, fails=0):
        self.rows, self.fails, self.calls = rows, fails, 0

    def __call__(self, spark, target):
        self.calls += 1
        if self.calls == self.fails:
            raise RuntimeError("lost")
        return self.rows


def test_a_failure_keeps_earlier_batches(spark):
    name, days = "t.batches_resume", events(spark, range(1, 6))
    with pytest.raises(RuntimeError):
        build_batches(spark, name, Model(days, fails=3), config(), at(6))
    assert stored(spark, name) == [(1, 0), (2, 0)] and done_batches(spark, name) == {at(1), at(2)}
    model = Model(events(spark, range(1, 6), 1))
    assert build_batches(spark, name, model, config(), at(6)) == [at(3), at(4), at(5)] and model.calls == 3
    assert stored(spark, name) == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 1)]
    assert build_batches(spark, name, model, config(), at(6)) == []
    # the newest is run again, and replaces its partition
    assert build_batches(spark, name, Model(events(spark, range(1, 6), 2)), config(lookback=1), at(6)) == [at(5)]
    assert stored(spark, name)[-1] == (5, 2) and len(stored(spark, name)) == 5


def test_holes_and_batches_in_one_job(spark):
    name, days = "t.batches_holes", events(spark, (1, 2, 4, 5, 6, 7))
    # an explicit range of another build leaves days 1, 2 and 5 to 7 out
    build_incremental(spark, name, lambda s, t: days, config(), batches=(at(3), at(5)))
    assert stored(spark, name) == [(4, 0)]
    model = Model(days)
    # day 3 is empty and day 7 is not over
    assert build_batches(spark, name, model, config(), at(7, 13), per_job=2) == [at(d) for d in (1, 2, 3, 5, 6, 7)]
    assert model.calls == 4 and len(stored(spark, name)) == 6
    assert done_batches(spark, name) == {at(d) for d in range(1, 7)}
    assert build_batches(spark, name, model, config(), at(7, 14), per_job=2) == [at(7)]
    assert len(stored(spark, name)) == 6


def test_refusals(spark):
    rows = events(spark, [1])
    with pytest.raises(ConfigError):
        build_batches(spark, "t.batches_no", lambda s, t: rows, config(), at(2), per_job=0)
    with pytest.raises(ConfigError):
        build_batches(spark, "t.batches_no", lambda s, t: rows, BuildConfig("microbatch", event_time="ts", batch_size="day"), at(2))
    assert build_batches(spark, "t.batches_no", lambda s, t: rows, config(), at(1)) == []
