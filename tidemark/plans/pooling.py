"""Batch pooling: read the registry and watermarks, count changes, write the ledger tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators import changes, ledger
from tidemark.operators.partition import literal
from tidemark.session import staged, staging
from tidemark.sources import tables

NTZ = T.TimestampNTZType()

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("started_at", NTZ),
        T.StructField("finished_at", NTZ),
        T.StructField("delta_end", NTZ),
        T.StructField("status", T.StringType()),
        T.StructField("num_tables", T.LongType()),
        T.StructField("num_warnings", T.LongType()),
        T.StructField("num_errors", T.LongType()),
        T.StructField("watermark_from", NTZ),
        T.StructField("summary", T.StringType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("at", NTZ),
        T.StructField("level", T.StringType()),
        T.StructField("full_table_name", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

#: Statuses that a run reports as a warning.
WARNED = ("not_found", "out_of_range")


class Ledger:
    """The ledger tables ``<name>_log``, ``_checkpoints``, ``_registry``, ``_runs`` and ``_run_events``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.log, self.checkpoints, self.registry, self.runs, self.events = (
            f"{name}_{part}" for part in ("log", "checkpoints", "registry", "runs", "run_events")
        )

    def create(self) -> Ledger:
        for name, schema in (
            (self.log, ledger.LOG_SCHEMA),
            (self.checkpoints, ledger.CHECKPOINT_SCHEMA),
            (self.registry, ledger.REGISTRY_SCHEMA),
            (self.runs, RUN_SCHEMA),
            (self.events, EVENT_SCHEMA),
        ):
            if not tables.is_table(self.spark, name):
                tables.create_table_as(self.spark.createDataFrame([], schema), name)
        return self

    def read(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, name)

    def has_run(self, name: str, run: str) -> bool:
        return not self.read(name).where(F.col("invocation_id") == run).isEmpty()


def append_new(rows: DataFrame, name: str, schema: T.StructType) -> None:
    rows.select([F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("append").insertInto(name)


def pool_ledger(
    book: Ledger,
    feed: DataFrame,
    end: datetime.datetime,
    *,
    run_id: str | None = None,
    now: Callable[[], datetime.datetime] = datetime.datetime.now,
    schedule_group: str | None = None,
    table_names: DataFrame | None = None,
    history_start: DataFrame | None = None,
) -> str:
    """Pool the changes of all enabled tables up to ``end`` and record them; returns the run's id.

    Log, registry and checkpoints are written in this order, so a watermark never runs ahead of its
    log, and the run's own row comes last. A run that is repeated under its id adds what a failure
    left out. ``schedule_group`` or ``table_names`` (full_table_name) restrict it to some tables.
    """
    spark = book.spark
    run = run_id or uuid.uuid4().hex
    started = now()
    with staging(spark):
        listed = ledger.list_registry(book.read(book.registry), enabled_only=True, schedule_group=schedule_group)
        if table_names is not None:
            listed = listed.join(table_names.select("full_table_name").distinct(), "full_table_name", "left_semi")
        marks = ledger.latest_checkpoints(book.read(book.checkpoints))
        pooled = changes.pool(listed, marks, feed, end, history_start=history_start)
        with staged(pooled, "pooled") as results:
            if not book.has_run(book.log, run):
                append_new(ledger.log_rows(results, started, run), book.log, ledger.LOG_SCHEMA)
            with staged(book.read(book.registry), "registry") as before:
                tables.create_table_as(ledger.record_pooling(before, results, started), book.registry)
            if not book.has_run(book.checkpoints, run):
                append_new(ledger.checkpoint_rows(results, started, now(), run), book.checkpoints, ledger.CHECKPOINT_SCHEMA)
            _record_run(book, results, run, started, now(), end)
    return run


def _record_run(book: Ledger, results: DataFrame, run: str, started, finished, end) -> None:
    """One row for the run, and one event for each table that was not simply pooled."""
    if not book.read(book.runs).where(F.col("run_id") == run).isEmpty():
        return
    level = F.when(F.col("status") == "error", "ERROR").when(F.col("status").isin(*WARNED), "WARNING")
    events = results.withColumn("level", level).where("level IS NOT NULL").select(
        F.lit(run).alias("run_id"),
        literal(finished).alias("at"),
        "level",
        "full_table_name",
        F.coalesce("error", "status").alias("message"),
    )
    if book.read(book.events).where(F.col("run_id") == run).isEmpty():
        append_new(events, book.events, EVENT_SCHEMA)
    warnings = events.where("level = 'WARNING'").select("run_id", "level")  # a failed table counts by its status
    mine = results.select(F.lit(run).alias("run_id"), "status", "delta_start")
    one = book.spark.createDataFrame([(run,)], "run_id string")
    row = one.join(ledger.run_summary(warnings, mine), "run_id", "left").withColumns(
        {
            "status": F.coalesce("status", F.lit("ok")),
            "started_at": literal(started),
            "finished_at": literal(finished),
            "delta_end": literal(end),
        }
    )
    append_new(row, book.runs, RUN_SCHEMA)


def ensure_affected(
    book: Ledger,
    requests: DataFrame,
    feed: DataFrame,
    *,
    pool_if_behind: bool = True,
    now: Callable[[], datetime.datetime] = datetime.datetime.now,
    history_start: DataFrame | None = None,
) -> DataFrame:
    """Affected partitions of each request, after pooling the tables that are behind its window.

    ``requests``: ``request_id, full_table_name, start, end``. Tables whose watermark does not reach the
    end of a window are pooled up to the latest such end, and the ledger is read again. A request that
    is still not covered, or one behind with ``pool_if_behind`` off, raises an error.
    """
    def covered() -> DataFrame:
        marks = ledger.latest_checkpoints(book.read(book.checkpoints))
        return changes.window_coverage(requests, marks, book.read(book.log))

    behind = covered().where("coverage <> 'complete'")
    latest = behind.agg(F.max("end").cast("timestamp_ntz")).first()[0]
    if latest is not None:
        if not pool_if_behind:
            raise ConfigError("changes are not pooled up to the end of the window")
        with staged(behind.select("full_table_name").distinct(), "behind") as names:
            pool_ledger(book, feed, latest, now=now, table_names=names, history_start=history_start)
        # a stored table may have been replaced since the plan above was made
        if not covered().where("coverage <> 'complete'").isEmpty():
            raise ConfigError("changes are still not pooled up to the end of the window")
    return covered().drop("watermark", "coverage")
