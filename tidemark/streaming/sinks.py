"""foreachBatch adapters: the batch operators as streaming sinks."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.errors import ConfigError
from tidemark.operators import changes, ledger
from tidemark.operators.merge import col, key_list, quoted
from tidemark.operators.sizing import split_by_keys
from tidemark.plans.incremental import merge_table, overwrite_table
from tidemark.session import staged, staging
from tidemark.sources import tables


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The newest row of each key, found in the map-side aggregate."""
    rest = [c for c in df.columns if c not in keys]
    # NULLs rank last, and a key with nothing else keeps a row
    order = F.struct(col(order_by).isNotNull(), col(order_by))
    newest = F.max_by(F.struct(*[col(c) for c in rest]), order).alias("__row")
    grouped = df.groupBy(*[col(k) for k in keys]).agg(newest)
    return grouped.select(
        *[col(k) for k in keys], *[F.col(f"__row.{quoted(c)}").alias(c) for c in rest]
    ).select(df.columns)


def merge_sink(name: str, unique_key: str | Sequence[str], *, order_by: str | None = None, **options) -> Callable:
    """Upsert each micro-batch into a table.

    With ``order_by`` the newest row of a key within a batch wins; without it a key that
    occurs twice in a batch is an error. A batch that is run again after a failure gives
    the same table, as an upsert of the same rows changes nothing.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = latest_per_key(batch, key_list(unique_key), order_by) if order_by else batch
        merge_table(spark, name, rows, unique_key, **options)

    return write


def overwrite_sink(name: str, run: str = "run") -> Callable:
    """Replace each partition by all rows that one run of a stream brings for it.

    The rows of every micro-batch are kept beside the table, by partition and batch, so that a partition
    that spans batches is written anew from all of them, and a batch that is run again replaces its own
    rows only. ``run`` names the run: a new one (another checkpoint folder) starts every partition afresh.
    """
    kept = f"{name}__{run}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partition, _ = tables.table_layout(spark, name)
        if partition is None:
            raise ConfigError(f"{name} is not partitioned")
        with staging(spark), staged(batch, "batch") as rows:
            ident = partition.id_expr()
            own = rows.where(ident.isNotNull()).withColumn(tables.BUCKET, F.concat(ident, F.lit(f" #{batch_id}")))
            if tables.is_table(spark, kept):
                tables.replace_partitions(own, kept)
            else:
                tables.create_table_as(own, kept)
            spark.catalog.refreshTable(kept)
            earlier = F.substring_index(F.col(tables.BUCKET), " #", 1)
            whole, _ = split_by_keys(spark.table(kept), earlier, rows.select(ident.alias("id")))
            overwrite_table(spark, name, whole.drop(tables.BUCKET).unionByName(rows.where(ident.isNull())))

    return write


def pooling_sink(
    log_table: str, checkpoint_table: str, registry_table: str, now: Callable, stream: str | None = None
) -> Callable:
    """Pool each micro-batch of a change feed into the ledger tables.

    Watermarks move past the newest change seen so far, and late rows widen the logged window
    back to them. Stream and batch id make a repeated batch recognisable: what it has recorded already
    is left alone, and what a failure left out is added. The stream's id is ``stream``, else that of
    its checkpoint folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        run = f"stream-{name}-{batch_id}"
        if _has_run(spark, checkpoint_table, run):
            return  # written last
        with staging(spark), staged(batch, "changes") as feed:
            end = feed.agg(F.max(changes.CHANGE_TIME).cast("timestamp_ntz").alias("t")).first()["t"]
            if end is None:
                return
            marks = ledger.latest_checkpoints(tables.read_table(spark, checkpoint_table))
            # past every watermark, so that a batch of late rows alone is pooled too
            newest = marks.agg(F.max("delta_end_time").alias("t")).first()["t"]
            stop = max(end, newest or end) + datetime.timedelta(microseconds=1)
            registry = tables.read_table(spark, registry_table)
            pooled = changes.pool(registry, marks, feed, stop, feed_is_delta=True)
            with staged(pooled, "pooled") as results:
                _record(log_table, checkpoint_table, registry_table, registry, results, now(), run)

    return write


def _has_run(spark: SparkSession, name: str, run: str) -> bool:
    return not tables.read_table(spark, name).where(F.col("invocation_id") == run).isEmpty()


def _record(log_table, checkpoint_table, registry_table, registry, results, moment, run) -> None:
    """Log, then registry, then checkpoints: a watermark never runs ahead of its log."""
    if not _has_run(results.sparkSession, log_table, run):
        ledger.log_rows(results, moment, run).write.mode("append").insertInto(log_table)
    tables.create_table_as(ledger.record_pooling(registry, results, moment), registry_table)
    ledger.checkpoint_rows(results, moment, moment, run).write.mode("append").insertInto(checkpoint_table)


def create_ledger(spark: SparkSession, log_table: str, checkpoint_table: str, registry_table: str) -> None:
    """Empty ledger tables."""
    for name, schema in (
        (log_table, ledger.LOG_SCHEMA),
        (checkpoint_table, ledger.CHECKPOINT_SCHEMA),
        (registry_table, ledger.REGISTRY_SCHEMA),
    ):
        if not tables.is_table(spark, name):
            tables.create_table_as(spark.createDataFrame([], schema), name)


def start(stream: DataFrame, sink: Callable, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Run a sink over a stream; by default over what is available now."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

