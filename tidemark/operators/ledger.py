"""Append-only records of what was pooled: checkpoints, change log, registry, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.changes import ADVANCING, first_rows
from tidemark.operators.merge import col
from tidemark.operators.partition import literal

NTZ = T.TimestampNTZType()

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("invocation_id", T.StringType()),
        T.StructField("full_table_name", T.StringType()),
        T.StructField("run_started_at", NTZ),
        T.StructField("node_started_at", NTZ),
        T.StructField("node_finished_at", NTZ),
        T.StructField("delta_start_time", NTZ),
        T.StructField("delta_end_time", NTZ),
        T.StructField("full_refresh", T.BooleanType()),
        T.StructField("success", T.BooleanType()),
    ]
)

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("full_table_name", T.StringType(), False),
        T.StructField("partition_type", T.StringType()),
        T.StructField("partition_granularity", T.StringType()),
        T.StructField("partition_field", T.StringType()),
        T.StructField("change_history_enabled", T.BooleanType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("schedule_group", T.StringType()),
        T.StructField("registered_at", NTZ),
        T.StructField("unregistered_at", NTZ),
        T.StructField("last_pooled_at", NTZ),
        T.StructField("last_status", T.StringType()),
        T.StructField("updated_at", NTZ),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("full_table_name", T.StringType(), False),
        T.StructField("pooled_at", NTZ),
        T.StructField("delta_start", NTZ),
        T.StructField("delta_end", NTZ),
        T.StructField("partition_type", T.StringType()),
        T.StructField("partition_granularity", T.StringType()),
        T.StructField("partition_field", T.StringType()),
        T.StructField("rows_changed", T.LongType()),
        T.StructField("rows_insert", T.LongType()),
        T.StructField("rows_update", T.LongType()),
        T.StructField("rows_delete", T.LongType()),
        T.StructField("partitions_changed_cnt", T.IntegerType()),
        T.StructField("partition_ids", T.ArrayType(T.StringType())),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("invocation_id", T.StringType()),
    ]
)


def _shape(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = set(df.columns)
    return df.select(
        [
            (col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def latest_checkpoints(ledger: DataFrame) -> DataFrame:
    """The newest successful checkpoint of each table; an unfinished one ranks last."""
    # max ignores a NULL finish time unless no row has one
    newest = F.max_by(
        F.struct(*[col(c) for c in ledger.columns]),
        F.struct(col("node_finished_at").isNotNull(), col("node_finished_at"), col("delta_end_time")),
    )
    latest = ledger.where(col("success")).groupBy("full_table_name").agg(newest.alias("row"))
    return latest.select("row.*")


def append_checkpoints(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The ledger with new rows, failed ones included."""
    return ledger.unionByName(_shape(rows, CHECKPOINT_SCHEMA).select(ledger.columns), allowMissingColumns=True)


def log_rows(results: DataFrame, pooled_at, invocation_id: str) -> DataFrame:
    """Pool results as change-log rows; skipped and missing tables leave none."""
    rows = results.where("logged").withColumns(
        {"pooled_at": literal(pooled_at), "invocation_id": F.lit(invocation_id)}
    )
    return _shape(rows, LOG_SCHEMA)


def checkpoint_rows(results: DataFrame, pooled_at, finished_at, invocation_id: str) -> DataFrame:
    """Checkpoints of the tables whose status moves the watermark forward."""
    rows = results.where(F.col("logged") & F.col("status").isin(ADVANCING)).select(
        F.lit(invocation_id).alias("invocation_id"),
        "full_table_name",
        literal(pooled_at).alias("run_started_at"),
        literal(pooled_at).alias("node_started_at"),
        literal(finished_at).alias("node_finished_at"),
        F.col("delta_start").alias("delta_start_time"),
        F.col("delta_end").alias("delta_end_time"),
        F.lit(False).alias("full_refresh"),
        F.lit(True).alias("success"),
    )
    return _shape(rows, CHECKPOINT_SCHEMA)


def _upsert(registry: DataFrame, rows: DataFrame, on_match, on_insert) -> DataFrame:
    """Registry after rows keyed by table name; both rules map a column name to a value."""
    fresh = first_rows(rows, "full_table_name")
    both = registry.alias("old").join(fresh.alias("new"), "full_table_name", "full_outer")
    in_old = F.col("old.registered_at").isNotNull() | F.col("old.enabled").isNotNull()
    in_new = F.col("new.__new")
    out = [F.col("full_table_name")]
    for field in REGISTRY_SCHEMA.fields[1:]:
        name = field.name
        old = col(name, "old")
        value = (
            F.when(in_new.isNull(), old).when(in_old, on_match(name, old)).otherwise(on_insert(name))
        )
        out.append(value.cast(field.dataType).alias(name))
    return both.select(out)


def record_pooling(registry: DataFrame, results: DataFrame, pooled_at) -> DataFrame:
    """Registry after a pooling run.

    Layout columns take the new value, the last status and time keep the old one where
    the new one is NULL, and a table not seen before is added enabled.
    """
    now = literal(pooled_at).cast(NTZ)
    rows = _shape(
        results.where("logged")
        .withColumnRenamed("status", "last_status")
        .withColumn("last_pooled_at", now),
        REGISTRY_SCHEMA,
    ).withColumn("__new", F.lit(True))
    replaced = {"partition_type", "partition_granularity", "partition_field", "change_history_enabled"}
    kept = {"last_status", "last_pooled_at"}

    def on_match(name, old):
        if name in replaced:
            return col(name, "new")
        if name in kept:
            return F.coalesce(col(name, "new"), old)
        return now if name == "updated_at" else old

    def on_insert(name):
        fixed = {
            "enabled": F.lit(True),
            "schedule_group": F.lit("default"),
            "registered_at": now,
            "updated_at": now,
        }
        return fixed.get(name, col(name, "new"))

    return _upsert(registry, rows, on_match, on_insert)


def register(registry: DataFrame, tables: DataFrame, now) -> DataFrame:
    """Registry with tables enabled; a table registered before becomes enabled again.

    ``tables``: ``full_table_name`` and optionally any layout column or ``schedule_group``.
    NULL never replaces a known value.
    """
    moment = literal(now).cast(NTZ)
    rows = _shape(tables, REGISTRY_SCHEMA).withColumn("__new", F.lit(True))

    def on_match(name, old):
        if name == "enabled":
            return F.lit(True)
        if name == "unregistered_at":
            return F.lit(None)
        if name == "updated_at":
            return moment
        return old if name == "registered_at" else F.coalesce(col(name, "new"), old)

    def on_insert(name):
        fixed = {
            "enabled": F.lit(True),
            "unregistered_at": F.lit(None),
            "schedule_group": F.coalesce(col("schedule_group", "new"), F.lit("default")),
            "registered_at": moment,
            "updated_at": moment,
        }
        return fixed.get(name, col(name, "new"))

    return _upsert(registry, rows, on_match, on_insert)


def unregister(registry: DataFrame, tables: DataFrame, now) -> DataFrame:
    """Registry with tables switched off; their rows stay."""
    moment = literal(now).cast(NTZ)
    off = tables.select("full_table_name", F.lit(True).alias("__off")).distinct()
    rows = registry.join(off, "full_table_name", "left")
    gone = F.col("__off").isNotNull()
    return rows.withColumns(
        {
            "enabled": F.when(gone, F.lit(False)).otherwise(F.col("enabled")),
            "unregistered_at": F.when(gone, moment).otherwise(F.col("unregistered_at")),
            "updated_at": F.when(gone, moment).otherwise(F.col("updated_at")),
        }
    ).select(registry.columns)


def list_registry(
    registry: DataFrame, *, enabled_only: bool = False, schedule_group: str | None = None
) -> DataFrame:
    if enabled_only:
        registry = registry.where(col("enabled") & col("unregistered_at").isNull())
    if schedule_group is not None:
        registry = registry.where(col("schedule_group") == schedule_group)
    return registry


def clamp_limit(n: int) -> int:
    """Number of recent runs a report may ask for."""
    return max(1, min(int(n), 500))


def recent_runs(runs: DataFrame, n: int = 50) -> DataFrame:
    return runs.orderBy(col("started_at").desc()).limit(clamp_limit(n))


def run_summary(events: DataFrame, results: DataFrame) -> DataFrame:
    """Outcome of each pooling run.

    ``events``: ``run_id, level``. ``results``: ``run_id, status, delta_start``. A failed
    table counts as an error besides the logged ones; errors outrank warnings.
    """
    if "run_id" not in events.columns or "run_id" not in results.columns:
        raise ConfigError("events and results need a run_id")
    level = F.upper(F.coalesce(col("level"), F.lit("INFO")))
    logged = events.groupBy("run_id").agg(
        F.count_if(level == "WARNING").alias("num_warnings"),
        F.count_if(level == "ERROR").alias("event_errors"),
    )
    by_status = results.groupBy("run_id", F.coalesce("status", F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.min("delta_start").alias("first")
    )
    pooled = by_status.groupBy("run_id").agg(
        F.sum("n").alias("num_tables"),
        F.sum(F.when(F.col("status") == "error", F.col("n")).otherwise(0)).alias("failed"),
        F.min("first").alias("watermark_from"),
        F.array_sort(F.collect_list(F.concat_ws("=", "status", "n"))).alias("parts"),
    )
    both = logged.join(pooled, "run_id", "full_outer")
    warnings = F.coalesce(F.col("num_warnings"), F.lit(0))
    errors = F.coalesce(F.col("event_errors"), F.lit(0)) + F.coalesce(F.col("failed"), F.lit(0))
    return both.select(
        "run_id",
        F.when(errors > 0, "error").when(warnings > 0, "warning").otherwise("ok").alias("status"),
        F.coalesce("num_tables", F.lit(0)).alias("num_tables"),
        warnings.alias("num_warnings"),
        errors.alias("num_errors"),
        "watermark_from",
        F.array_join("parts", ", ").alias("summary"),
    )
