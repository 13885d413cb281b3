"""Event-time microbatches that note what is done, so that a run after a failure takes up where it ended."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import ConfigError
from tidemark.plans.incremental import (
    BuildConfig,
    batch_start,
    batch_windows,
    check_microbatch,
    overwrite_table,
)
from tidemark.sources import tables
from tidemark.sources.loads import event_time_filter


def done_batches(spark: SparkSession, name: str) -> set[datetime.datetime]:
    """Starts of the batches noted as done; of a table without notes, those that have a partition.

    The driver reads one value a batch.
    """
    notes = f"{name}__batches"
    if tables.is_table(spark, notes):
        spark.catalog.refreshTable(notes)
        return {datetime.datetime.fromisoformat(r[0]) for r in spark.table(notes).distinct().collect()}
    if not tables.is_table(spark, name):
        return set()
    ids = tables.list_partitions(spark, name).where("partition_id IS NOT NULL").collect()
    return {datetime.datetime.fromisoformat(r[0]) for r in ids}


def missing_batches(
    done: set[datetime.datetime], begin: datetime.datetime, now: datetime.datetime, batch_size: str, lookback: int
) -> list[tuple[datetime.datetime, datetime.datetime]]:
    """Windows up to ``now`` that are not done, and the ``lookback`` newest ones that are."""
    again = sorted(done)[len(done) - min(lookback, len(done)) :]
    return [w for w in batch_windows(begin, now, batch_size) if w[0] not in done or w[0] in again]


def _jobs(windows: list[tuple], per_job: int) -> list[list[tuple]]:
    """Runs of windows without a gap, of at most ``per_job`` each."""
    jobs: list[list[tuple]] = []
    for window in windows:
        if jobs and len(jobs[-1]) < per_job and jobs[-1][-1][1] == window[0]:
            jobs[-1].append(window)
        else:
            jobs.append([window])
    return jobs


def _note(spark: SparkSession, name: str, starts: list[datetime.datetime]) -> None:
    notes = f"{name}__batches"
    rows = spark.createDataFrame([(s.isoformat(),) for s in starts], "batch_start string").coalesce(1)
    if tables.is_table(spark, notes):
        tables.append_rows(rows, notes)
    else:
        tables.create_table_as(rows, notes)


def build_batches(
    spark: SparkSession,
    name: str,
    model: Callable[[SparkSession, DataFrame | None], DataFrame],
    config: BuildConfig,
    now: datetime.datetime,
    *,
    per_job: int = 1,
) -> list[datetime.datetime]:
    """Run the batches that are missing, oldest first, and return their starts.

    A batch is noted once its rows are stored; a failure keeps what was noted, and the next run begins with the batch
    that failed. Running a batch again replaces its partition, so one that failed between its rows and its note does
    no harm. Holes, such as an explicit range leaves, are missing batches like any other. The batch that holds ``now``
    is not whole and is never noted. ``per_job`` batches without a gap are one Spark job and one note.
    """
    check_microbatch(config.partition, config.batch_size)
    if config.event_time is None or config.begin is None:
        raise ConfigError("microbatch needs event_time and begin")
    if per_job < 1:
        raise ConfigError("per_job must be at least 1")
    done = done_batches(spark, name)
    if done and not tables.is_table(spark, f"{name}__batches"):
        _note(spark, name, sorted(d for d in done if d != batch_start(now, config.batch_size)))
    windows = missing_batches(done, config.begin, now, config.batch_size, config.lookback)
    for job in _jobs(windows, per_job):
        exists = tables.is_table(spark, name)
        target = tables.read_table(spark, name) if exists else None
        rows = config.shape(event_time_filter(model(spark, target), config.event_time, job[0][0], job[-1][1]))
        if exists:
            overwrite_table(spark, name, rows)
        else:
            tables.create_table_as(rows, name, config.partition, config.cluster_by)
        whole = [start for start, stop in job if stop <= now and start not in done]
        if whole:
            _note(spark, name, whole)
    return [start for start, _ in windows]
