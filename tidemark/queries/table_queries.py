"""Tables written and read back: builds, copies, loads, views and incremental runs."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ledger
from tidemark.operators.aggregates import Measure, change_images
from tidemark.operators.buckets import KeyBuckets
from tidemark.operators.changes import changed_partitions, snapshot_diff
from tidemark.operators.catalog import catalog_report
from tidemark.operators.fanout import fan_out
from tidemark.operators.partition import IntRange, PartitionSpec, literal
from tidemark.plans.batches import build_batches
from tidemark.plans.incremental import (
    BuildConfig,
    build_incremental,
    build_parameterised,
    delete_from_table,
    merge_table,
    overwrite_table,
    recompute_dirty,
)
from tidemark.plans.maintained import MaintainedView
from tidemark.plans.pooling import Ledger, ensure_affected, pool_ledger
from tidemark.plans.snapshots import snapshot_table
from tidemark.queries.overwrite_queries import COLUMNS, DAY, LISTED, LISTED_DAYS, RELOADED, SHIFT, peak_days, reloaded
from tidemark.queries.registry import query
from tidemark.session import scratch_path, shared_dir
from tidemark.sources import tables
from tidemark.sources.listing import real_tables
from tidemark.sources.loads import load, read_shards, schema_only
from tidemark.streaming import sinks

ORDER_YEAR = PartitionSpec("o_orderdate", "datetime", "year")


def table(t, name: str) -> str:
    """An unused table name in this application's own database below the shared folder."""
    spark = t.spark
    app = spark.sparkContext.applicationId.replace("-", "_")
    database = f"tidemark_{app}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{shared_dir(spark)}/{database}'")
    return f"{database}.{name}_{uuid.uuid4().hex[:8]}"


@query("table_ctas_partitioned", f"SELECT {COLUMNS} FROM events")
def table_ctas_partitioned(t):
    name = table(t, "ctas")
    tables.create_table_as(t.events, name, DAY, ["user_id", "event_type"])
    return tables.read_table(t.spark, name)


@query("partitions_listed", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS partition_id FROM events")
def partitions_listed(t):
    name = table(t, "listed")
    tables.create_table_as(t.events, name, DAY)
    return tables.list_partitions(t.spark, name)


@query(
    "view_model",
    "SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey",
)
def view_model(t):
    rich = t.customer.where("c_acctbal > 0").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    tables.create_view_as(rich, "tidemark_rich_customers")
    return t.spark.table("tidemark_rich_customers")


@query(
    "ephemeral_chain",
    """
WITH base AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'),
top AS (SELECT o_custkey, max(o_totalprice) AS largest FROM base GROUP BY o_custkey)
SELECT c_name, largest FROM top JOIN customer ON o_custkey = c_custkey
""",
)
def ephemeral_chain(t):
    base = t.orders.where("o_orderstatus = 'O'").select("o_custkey", "o_totalprice")
    top = base.groupBy("o_custkey").agg(F.max("o_totalprice").alias("largest"))
    return top.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "largest")


@query("seed_csv_types", "SELECT s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey, s_acctbal FROM supplier")
def seed_csv_types(t):
    path = scratch_path(t.spark, "csv")
    t.supplier.write.option("header", True).option("sep", ";").csv(path)
    name = table(t, "seed")
    tables.load_seed(load(t.spark, path, "csv", overrides={"s_nationkey": "string"}, delimiter=";"), name)
    return tables.read_table(t.spark, name)


@query("load_ndjson", "SELECT event_id, ts, user_id, event_type, value FROM events")
def load_ndjson(t):
    path = scratch_path(t.spark, "ndjson")
    t.events.drop("props").write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return load(t.spark, path, "json", overrides={"ts": "timestamp_ntz", "value": "double"})


@query("load_parquet", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def load_parquet(t):
    declared = "n_nationkey bigint, n_name string"
    return load(t.spark, f"{t.folder}/nation.parquet", "parquet", schema=declared)


@query("copy_append", "SELECT * FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT * FROM supplier")
def copy_append(t):
    name = table(t, "copy_append")
    tables.copy_table(t.supplier.where("s_acctbal < 0"), name, "table")
    tables.copy_table(t.supplier, name, "incremental")
    return tables.read_table(t.spark, name)


@query("copy_truncate_multi", "SELECT * FROM supplier WHERE s_acctbal >= 0 UNION ALL SELECT * FROM supplier")
def copy_truncate_multi(t):
    name = table(t, "copy_truncate")
    tables.copy_table(t.supplier.where("s_acctbal < 0"), name, "table")
    tables.copy_table([t.supplier.where("s_acctbal >= 0"), t.supplier], name, "table")
    return tables.read_table(t.spark, name)


@query("clone_table", "SELECT * FROM customer")
def clone_table(t):
    name, copy = table(t, "clone_from"), table(t, "clone_to")
    tables.create_table_as(t.customer, name, cluster_by=["c_nationkey"])
    tables.clone(t.spark, name, copy)
    return tables.read_table(t.spark, copy)


@query("date_shard_scan", "SELECT strftime(ts, '%Y%m%d') AS shard_date, count(*) AS n, max(event_id) AS last FROM events GROUP BY ALL")
def date_shard_scan(t):
    folder = scratch_path(t.spark, "shards")
    label = F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"))
    t.events.withColumn("shard", label).write.partitionBy("shard").parquet(folder)
    shards = read_shards(t.spark, f"{folder}/shard=events_*")
    return shards.groupBy("shard_date").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


@query("python_model", "SELECT s_suppkey, s_acctbal * 2 AS doubled FROM supplier")
def python_model(t):
    name = table(t, "python_model")

    def model(spark):
        return t.supplier.select("s_suppkey", (F.col("s_acctbal") * 2).alias("doubled")).pandas_api()

    tables.python_model(t.spark, model, name, cluster_by=["s_suppkey"])
    return tables.read_table(t.spark, name)


@query("schema_only", "SELECT * FROM lineitem WHERE FALSE")
def empty_lines(t):
    return schema_only(t.lineitem)


@query(
    "mv_refresh",
    "SELECT l_returnflag, count(*) AS n, max(l_shipdate) AS last FROM lineitem GROUP BY l_returnflag",
)
def mv_refresh(t):
    name = table(t, "mv")

    def by_flag(condition):
        return lambda spark: t.lineitem.where(condition).groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("last")
        )

    start = datetime.datetime(2024, 1, 1)
    tables.MaterializedView(name, by_flag("l_quantity > 25")).refresh(t.spark, start)
    view = tables.MaterializedView(name, by_flag("true"))
    fresh = view.refresh(t.spark, start + datetime.timedelta(minutes=10))
    due = view.refresh(t.spark, start + datetime.timedelta(minutes=30))
    if fresh or not due:
        raise AssertionError("refresh did not follow its interval")
    return tables.read_table(t.spark, name)


@query("relayout_table", "SELECT strftime(ts, '%Y-%m-01') AS partition_id, count(*) AS n FROM events GROUP BY ALL")
def relayout_table(t):
    name = table(t, "relayout")
    tables.create_table_as(t.events, name, DAY)
    tables.relayout(t.spark, name, PartitionSpec("ts", "datetime", "month"), ["user_id"])
    return t.spark.table(name).groupBy(F.col(tables.BUCKET).alias("partition_id")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "table_alterations",
    "SELECT c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, c_acctbal, CAST(NULL AS BIGINT) AS score FROM customer",
)
def table_alterations(t):
    name, renamed = table(t, "altered"), table(t, "altered_renamed")
    tables.create_table_as(t.customer, name)
    tables.add_table_columns(t.spark, name, [T.StructField("score", T.LongType())])
    tables.rewrite_table(
        t.spark,
        name,
        lambda df: df.drop("c_mktsegment").withColumn("c_nationkey", F.col("c_nationkey").cast("string")),
    )
    tables.rename_table(t.spark, name, renamed)
    return tables.read_table(t.spark, renamed)


# incremental builds over two runs

FIRST_DAYS = "ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'"
LAST_DAYS = "ts >= TIMESTAMP_NTZ '2024-01-18 00:00:00'"


def two_runs(t, name, config):
    def model(spark, target):
        return t.events.where(FIRST_DAYS) if target is None else reloaded(t, LAST_DAYS)

    full = table(t, name)
    build_incremental(t.spark, full, model, config)
    build_incremental(t.spark, full, model, config)
    return tables.read_table(t.spark, full)


@query(
    "incremental_two_runs",
    f"SELECT {COLUMNS} FROM events WHERE ts < TIMESTAMP '2024-01-18' UNION ALL {RELOADED} WHERE ts >= TIMESTAMP '2024-01-18'",
)
def incremental_two_runs(t):
    return two_runs(t, "two_runs", BuildConfig("insert_overwrite", partition=DAY, cluster_by=("user_id",)))


@query(
    "incremental_merge_runs",
    """
SELECT event_id, ts, user_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-18' THEN value + 1 ELSE value END AS value, props
FROM events
""",
)
def incremental_merge_runs(t):
    def model(spark, target):
        if target is None:
            return t.events.where(FIRST_DAYS)
        return t.events.where(LAST_DAYS).withColumn("value", F.col("value") + 1)

    full = table(t, "merge_runs")
    config = BuildConfig("merge", unique_key="event_id", partition=DAY)
    for _ in range(2):
        build_incremental(t.spark, full, model, config)
    return tables.read_table(t.spark, full)


@query(
    "incremental_yearly_merge",
    """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-10-01' AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders
""",
)
def incremental_yearly_merge(t):
    full = table(t, "yearly_merge")
    tables.create_table_as(t.orders, full, ORDER_YEAR)
    late = t.orders.where("o_orderdate >= TIMESTAMP_NTZ '1999-10-01 00:00:00' AND o_orderstatus = 'O'")
    merge_table(t.spark, full, late.withColumn("o_orderstatus", F.lit("F")), "o_orderkey")
    return tables.read_table(t.spark, full)


@query(
    "incremental_static_table",
    f"""
SELECT {COLUMNS} FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08')
UNION ALL {RELOADED} WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-09'
""",
)
def incremental_static_table(t):
    full = table(t, "static_table")
    tables.create_table_as(t.events, full, DAY)
    overwrite_table(t.spark, full, reloaded(t, LISTED), partitions=LISTED_DAYS)
    return tables.read_table(t.spark, full)


@query(
    "incremental_schema_append",
    """
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN ts >= TIMESTAMP '2024-01-18' THEN upper(event_type) END AS kind
FROM events
""",
)
def incremental_schema_append(t):
    def model(spark, target):
        if target is None:
            return t.events.where(FIRST_DAYS)
        return t.events.where(LAST_DAYS).withColumn("kind", F.upper("event_type"))

    full = table(t, "schema_append_runs")
    config = BuildConfig("insert_overwrite", partition=DAY, on_schema_change="append_new_columns")
    for _ in range(2):
        build_incremental(t.spark, full, model, config)
    return tables.read_table(t.spark, full)


@query(
    "incremental_microbatch",
    f"SELECT {COLUMNS} FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'",
)
def incremental_microbatch(t):
    full = table(t, "microbatch_runs")
    config = BuildConfig(
        "microbatch", partition=DAY, event_time="ts", batch_size="day", begin=datetime.datetime(2024, 1, 10, 5)
    )
    for day in (15, 20):
        build_incremental(t.spark, full, lambda s, target: t.events, config, now=datetime.datetime(2024, 1, day, 9))
    return tables.read_table(t.spark, full)


@query(
    "incremental_ext_build",
    f"""
WITH picked AS (SELECT DISTINCT CAST(arg_max(ts, value) AS DATE) AS d FROM events GROUP BY event_type)
{RELOADED} WHERE CAST(ts AS DATE) IN (SELECT d FROM picked)
""",
)
def incremental_ext_build(t):
    days = peak_days(t).select(F.col("dt").cast("string").alias("dt"))

    def model(spark, params):
        day = F.to_date("params.dt")
        rows = reloaded(t, "true")
        return fan_out(rows, params.select("dt"), lambda: F.col("query.ts").cast("date") == day)

    full = table(t, "ext_build")
    config = BuildConfig("insert_overwrite", partition=DAY)
    for _ in range(2):
        build_parameterised(t.spark, full, model, days, config, source_param="dt")
    return tables.read_table(t.spark, full)


@query(
    "dirty_table_rebuild",
    """
WITH after AS (
  SELECT event_id, ts, user_id, event_type, CASE WHEN value > 330 THEN 0 ELSE value END AS value, props FROM events
)
SELECT * FROM after
""",
)
def dirty_table_rebuild(t):
    full = table(t, "dirty_table")
    after = t.events.withColumn("value", F.when(F.col("value") > 330, 0.0).otherwise(F.col("value")))
    tables.create_table_as(t.events, full, DAY)
    dirty = changed_partitions(snapshot_diff(t.events, after, "event_id", compare=["value"]), DAY)
    recompute_dirty(t.spark, full, after, dirty)
    return tables.read_table(t.spark, full)


@query("store_failures", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 195000")
def store_failures(t):
    name = table(t, "failures")
    failing = t.orders.where("o_totalprice > 195000").select("o_orderkey", "o_totalprice")
    tables.store_failures(failing, name)
    return tables.read_table(t.spark, name)


# streams over the stored files, run until all of them are read


def run_stream(t, table_name, prepare, sink, parts=None):
    """Stream a table's own files; with ``parts`` it is first cut into that many, read one in each batch."""
    df = getattr(t, table_name)
    reader = t.spark.readStream.schema(df.schema)
    if parts is None:
        # the pattern holds the one name, as a stream reads folders or patterns only
        stream = reader.parquet(f"{t.folder}/{table_name}.parque[t]")
    else:
        path = scratch_path(t.spark, "stream-input")
        df.repartition(parts, F.col(df.columns[0])).write.parquet(path)
        stream = reader.option("maxFilesPerTrigger", 1).parquet(path)
    query = sinks.start(prepare(stream), sink, scratch_path(t.spark, "stream"))
    query.awaitTermination()


@query(
    "stream_upsert",
    "SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'view' THEN value * 2 ELSE value END AS value, props FROM events",
)
def stream_upsert(t):
    name = table(t, "stream_upsert")
    tables.create_table_as(t.events.where(FIRST_DAYS), name, DAY)
    doubled = F.when(F.col("event_type") == "view", F.col("value") * 2).otherwise(F.col("value"))
    sink = sinks.merge_sink(name, "event_id", order_by="ts")
    run_stream(t, "events", lambda stream: stream.withColumn("value", doubled), sink)
    return tables.read_table(t.spark, name)


@query(
    "stream_overwrite",
    f"SELECT {COLUMNS} FROM events WHERE ts < TIMESTAMP '2024-01-18' UNION ALL {RELOADED} WHERE ts >= TIMESTAMP '2024-01-18'",
)
def stream_overwrite(t):
    name = table(t, "stream_overwrite")
    tables.create_table_as(t.events.where(FIRST_DAYS), name, DAY)

    def late(stream):
        shifted = {"event_id": F.col("event_id") + SHIFT, "value": F.col("value") + 1}
        return stream.where(LAST_DAYS).withColumns(shifted)

    # every day spans all files, and every batch reads one file
    run_stream(t, "events", late, sinks.overwrite_sink(name), parts=3)
    return tables.read_table(t.spark, name)


@query(
    "stream_pooling",
    """
SELECT 'raw.' || event_type AS full_table_name, 'ok' AS status, count(*) AS rows_changed,
       string_agg(DISTINCT strftime(ts, '%Y-%m-%d'), ',' ORDER BY strftime(ts, '%Y-%m-%d')) AS partition_ids
FROM events GROUP BY event_type
""",
)
def stream_pooling(t):
    log, marks, known = (table(t, f"stream_{n}") for n in ("log", "marks", "registry"))
    sinks.create_ledger(t.spark, log, marks, known)
    start = datetime.datetime(2023, 1, 1)
    names = t.events.select(F.concat(F.lit("raw."), "event_type").alias("full_table_name")).distinct()
    listed = names.selectExpr("*", "'time' AS partition_type", "'day' AS partition_granularity", "'ts' AS partition_field")
    tables.create_table_as(ledger.register(tables.read_table(t.spark, known), listed, start), known)
    moment = literal(start)
    first = names.select("*", moment.alias("node_finished_at"), moment.alias("delta_end_time"), F.lit(True).alias("success"))
    tables.append_rows(ledger.append_checkpoints(t.spark.createDataFrame([], ledger.CHECKPOINT_SCHEMA), first), marks)

    def feed(stream):
        return stream.select(
            F.concat(F.lit("raw."), "event_type").alias("full_table_name"),
            F.lit("INSERT").alias("_change_type"),
            F.col("ts").alias("_change_timestamp"),
            DAY.id_expr().alias("partition_id"),
        )

    run_stream(t, "events", feed, sinks.pooling_sink(log, marks, known, now=lambda: start))
    return tables.read_table(t.spark, log).select(
        "full_table_name", "status", "rows_changed", F.array_join("partition_ids", ",").alias("partition_ids")
    )


# pooling into ledger tables: one table per event type, known since the start of the year


def pooled_ledger(t, name):
    book = Ledger(t.spark, table(t, name)).create()
    start = datetime.datetime(2023, 1, 1)
    names = t.events.select(F.concat(F.lit("raw."), "event_type").alias("full_table_name")).distinct()
    listed = names.selectExpr("*", "'time' AS partition_type", "'day' AS partition_granularity", "'ts' AS partition_field")
    tables.create_table_as(ledger.register(book.read(book.registry), listed, start), book.registry)
    moment = literal(start)
    first = names.select("*", moment.alias("node_finished_at"), moment.alias("delta_end_time"), F.lit(True).alias("success"))
    tables.append_rows(ledger.append_checkpoints(t.spark.createDataFrame([], ledger.CHECKPOINT_SCHEMA), first), book.checkpoints)
    return book


def event_feed(t):
    return t.events.select(
        F.concat(F.lit("raw."), "event_type").alias("full_table_name"),
        F.lit("INSERT").alias("_change_type"),
        F.col("ts").alias("_change_timestamp"),
        DAY.id_expr().alias("partition_id"),
    )


@query(
    "pool_ledger_run",
    """
WITH parts AS (
  SELECT event_type, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS run, ts FROM events
),
types AS (SELECT DISTINCT event_type FROM events)
SELECT 'raw.' || t.event_type AS full_table_name, r.run::INTEGER AS run, 'ok' AS status, count(p.ts) AS rows_changed,
       coalesce(string_agg(DISTINCT strftime(p.ts, '%Y-%m-%d'), ',' ORDER BY strftime(p.ts, '%Y-%m-%d')), '') AS partition_ids,
       CASE r.run WHEN 1 THEN TIMESTAMP '2024-01-16' ELSE TIMESTAMP '2025-01-01' END AS delta_end, 2 AS runs
FROM types t CROSS JOIN (SELECT unnest([1, 2]) AS run) r
LEFT JOIN parts p ON p.event_type = t.event_type AND p.run = r.run
GROUP BY ALL
""",
)
def pool_ledger_run(t):
    """Two runs, the second one repeated under its id."""
    book = pooled_ledger(t, "pool")
    for run, end in (("1", datetime.datetime(2024, 1, 16)), ("2", datetime.datetime(2025, 1, 1)), ("2", datetime.datetime(2025, 1, 1))):
        pool_ledger(book, event_feed(t), end, run_id=run, now=lambda e=end: e)
    runs = book.read(book.runs).where("status = 'ok'").agg(F.count(F.lit(1)).cast("int").alias("runs"))
    return book.read(book.log).select(
        "full_table_name", F.col("invocation_id").cast("int").alias("run"), "status", "rows_changed",
        F.array_join("partition_ids", ",").alias("partition_ids"), "delta_end",
    ).join(F.broadcast(runs), F.lit(True))  # one row


@query(
    "ensure_affected_partitions",
    """
WITH asked AS (
  SELECT 'raw.' || event_type AS full_table_name, min(ts) AS start, max(ts) AS "end" FROM events GROUP BY event_type
),
latest AS (SELECT max("end") AS stop FROM asked)
SELECT a.full_table_name AS request_id, a.full_table_name,
       string_agg(DISTINCT strftime(e.ts, '%Y-%m-%d'), ',' ORDER BY strftime(e.ts, '%Y-%m-%d')) AS partition_ids
FROM asked a CROSS JOIN latest l JOIN events e ON 'raw.' || e.event_type = a.full_table_name AND e.ts < l.stop
GROUP BY ALL
""",
)
def ensure_affected_partitions(t):
    book = pooled_ledger(t, "ensure")
    asked = t.events.groupBy(F.concat(F.lit("raw."), "event_type").alias("full_table_name")).agg(
        F.min("ts").alias("start"), F.max("ts").alias("end")
    ).withColumn("request_id", F.col("full_table_name"))
    found = ensure_affected(book, asked, event_feed(t), now=lambda: datetime.datetime(2025, 1, 1))
    return found.select("request_id", "full_table_name", F.array_join("partition_ids", ",").alias("partition_ids"))


@query(
    "snapshot_table_same_time",
    """
SELECT c_custkey, c_mktsegment AS seen, TRUE AS open FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, 'a', FALSE FROM customer
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN 'b' END, TRUE FROM customer WHERE c_custkey % 2 = 1
""",
)
def snapshot_table_same_time(t):
    """Two runs with the same time, each closing half of the versions, and one without changes."""
    name = table(t, "same_time")
    first = t.customer.select("c_custkey", F.lit("a").alias("seen"))
    odd, even = F.col("c_custkey") % 2 == 1, F.col("c_custkey") % 2 == 0
    second = t.customer.select("c_custkey", F.when(odd, "b").otherwise("a").alias("seen"))
    third = t.customer.select("c_custkey", F.when(odd, F.lit("b")).when(even, F.col("c_mktsegment")).alias("seen"))
    run = datetime.datetime(2024, 1, 2)
    for state, now in ((first, datetime.datetime(2024, 1, 1)), (second, run), (third, run), (third, run)):
        snapshot_table(t.spark, name, state, "c_custkey", strategy="check", check_cols=["seen"], now=now)
    return tables.read_table(t.spark, name).select("c_custkey", "seen", F.col("valid_to").isNull().alias("open"))


@query(
    "incremental_ext_undated",
    f"""
WITH picked AS (SELECT DISTINCT CAST(arg_max(ts, value) AS DATE) AS d FROM events GROUP BY event_type)
SELECT {COLUMNS} FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT d FROM picked) AND value <= 200
UNION ALL SELECT event_id, NULL, user_id, event_type, value, props FROM events WHERE value > 200
UNION ALL {RELOADED} WHERE CAST(ts AS DATE) IN (SELECT d FROM picked)
""",
)
def incremental_ext_undated(t):
    """A parameterised overwrite leaves the rows without a date alone."""
    days = peak_days(t).select(F.col("dt").cast("string").alias("dt"))

    def model(spark, params):
        day = F.to_date("params.dt")
        return fan_out(reloaded(t, "true"), params.select("dt"), lambda: F.col("query.ts").cast("date") == day)

    name = table(t, "undated")
    undated = t.events.withColumn("ts", F.when(F.col("value") <= 200, F.col("ts")))
    tables.create_table_as(undated, name, DAY)
    build_parameterised(t.spark, name, model, days, BuildConfig("insert_overwrite", partition=DAY), source_param="dt")
    return tables.read_table(t.spark, name)


@query(
    "delete_table_partitions",
    f"SELECT {COLUMNS} FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' AND value > 50)",
)
def delete_table_partitions(t):
    """Rows of three days are deleted; other days are neither read nor written."""
    name = table(t, "deleted")
    tables.create_table_as(t.events, name, DAY)
    delete_from_table(t.spark, name, "value > 50", ["2024-01-10", "2024-01-11", "2024-01-12"])
    return tables.read_table(t.spark, name)


@query(
    "merge_int_buckets",
    """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 3 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
""",
)
def merge_int_buckets(t):
    """Only the buckets that hold a key of the source are written."""
    name = table(t, "int_buckets")
    layout = PartitionSpec("c_nationkey", "int64", range=IntRange(0, 25, 5))
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    tables.create_table_as(t.customer.select(columns), name, layout)
    changed = t.customer.where("c_nationkey = 3").withColumn("c_acctbal", F.lit(0.0)).select(columns)
    merge_table(t.spark, name, changed, "c_custkey", partition_scope="all")
    return tables.read_table(t.spark, name)


@query(
    "catalog_tables",
    """
SELECT name AS table_name, n AS row_count, p AS partition_column FROM (
  SELECT 'events' AS name, count(*) AS n, 'ts' AS p FROM events UNION ALL SELECT 'nation', count(*), NULL FROM nation
)
""",
)
def catalog_tables(t):
    """Sizes and row counts of stored tables, from their files' footers; the third one is not asked for."""
    named = {part: table(t, f"listed_{part}") for part in ("events", "nation", "region")}
    for part, name in named.items():
        tables.create_table_as(getattr(t, part), name, DAY if part == "events" else None)
    database = named["events"].split(".")[0]
    wanted = [named[p].split(".")[1] for p in ("events", "nation")]
    found, columns = real_tables(t.spark, database, wanted)
    report = catalog_report(found, columns).where("size_bytes > 0").select(
        F.regexp_extract("table_name", "^listed_([a-z]+)_", 1).alias("table_name"), "row_count", "partition_column"
    )
    return report.distinct()


MAINTAINED = """
SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 10 = 5
THEN 7 ELSE 0 END) AS BIGINT) AS cents, min(o_orderdate) AS first, max(o_totalprice) AS most
FROM orders WHERE o_orderkey % 10 <> 4 GROUP BY o_custkey
"""


@query("mv_maintained", MAINTAINED)
def mv_maintained(t):
    """The view was computed when some orders were missing; the feed adds, changes and removes orders."""
    name, source = table(t, "mv_maintained"), table(t, "mv_source")
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    digit = F.col("o_orderkey") % 10
    before = orders.where(digit != 3)
    after = orders.where(digit != 4).withColumn("cents", F.col("cents") + F.when(digit == 5, 7).otherwise(0))
    start = datetime.datetime(2024, 1, 1)
    measures = {
        "n": Measure("count"), "cents": Measure("sum", "cents"),
        "first": Measure("min", "o_orderdate"), "most": Measure("max", "o_totalprice"),
    }
    view = MaintainedView(name, source, ["o_custkey"], measures)
    tables.create_table_as(before, source, buckets=KeyBuckets(("o_custkey",), 16))
    view.create(t.spark, start)
    feed = change_images(before, after, "o_orderkey").withColumn("_change_timestamp", F.lit(start))
    tables.create_table_as(after, source, buckets=KeyBuckets(("o_custkey",), 16))
    view.refresh(t.spark, feed, start + datetime.timedelta(minutes=30))
    return view.read(t.spark)


@query("microbatch_resumed", "SELECT event_id, ts, user_id, event_type, value FROM events")
def microbatch_resumed(t):
    """The third job of the first run fails; the second run does what is missing."""
    name = table(t, "resumed")
    rows = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    config = BuildConfig("microbatch", partition=DAY, event_time="ts", batch_size="day", begin=first, lookback=0)
    now, calls = last + datetime.timedelta(days=1), []

    def fails(spark, target):
        calls.append(target)
        if len(calls) == 3:
            raise ConnectionError("the third job is lost")
        return rows

    try:
        build_batches(t.spark, name, fails, config, now, per_job=10)
    except ConnectionError:
        pass
    build_batches(t.spark, name, lambda spark, target: rows, config, now, per_job=10)
    return tables.read_table(t.spark, name)
