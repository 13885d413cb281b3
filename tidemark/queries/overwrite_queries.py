"""Partition overwrite, microbatches, partition expressions and partition lists."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidemark.operators.overwrite import insert_overwrite, overwrite_buckets
from tidemark.operators.partition import IntRange, PartitionSpec
from tidemark.plans.incremental import microbatch
from tidemark.queries.registry import query
from tidemark.sources.loads import after_max_partition, event_time_filter
from tidemark.sources.tables import partition_rows

DAY = PartitionSpec("ts", "datetime", "day")
HOUR = PartitionSpec("ts", "datetime", "hour")
SHIFT = 1_000_000_000_000
COLUMNS = "event_id, ts, user_id, event_type, value, props"


def reloaded(t, condition):
    """Events of a period loaded again with other ids and values."""
    return t.events.where(condition).withColumns(
        {"event_id": F.col("event_id") + SHIFT, "value": F.col("value") + 1}
    )


RELOADED = f"SELECT event_id + {SHIFT} AS event_id, ts, user_id, event_type, value + 1 AS value, props FROM events"


@query(
    "overwrite_dynamic_day",
    f"""
WITH s AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts, user_id, event_type, value, props
  FROM ({RELOADED} WHERE ts >= TIMESTAMP '2024-01-20')
)
SELECT {COLUMNS} FROM events
WHERE date_trunc('day', ts) NOT IN (SELECT date_trunc('day', ts) FROM s WHERE ts IS NOT NULL)
UNION ALL SELECT {COLUMNS} FROM s
""",
)
def overwrite_dynamic_day(t):
    source = reloaded(t, "ts >= TIMESTAMP_NTZ '2024-01-20 00:00:00'").withColumn(
        "ts", F.expr("CASE WHEN event_type = 'error' THEN NULL ELSE ts END")
    )
    return insert_overwrite(t.events, source, DAY)


@query(
    "overwrite_dynamic_hour",
    f"""
WITH s AS ({RELOADED} WHERE hour(ts) = 5)
SELECT {COLUMNS} FROM events WHERE date_trunc('hour', ts) NOT IN (SELECT date_trunc('hour', ts) FROM s)
UNION ALL SELECT {COLUMNS} FROM s
""",
)
def overwrite_dynamic_hour(t):
    return insert_overwrite(t.events, reloaded(t, "hour(ts) = 5"), HOUR)


CUSTOMER_RANGE = PartitionSpec("o_custkey", "int64", range=IntRange(0, 100_000_000, 10))


@query(
    "overwrite_dynamic_int_range",
    """
WITH s AS (SELECT o_orderkey, o_custkey, 'R' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01')
SELECT * FROM orders
WHERE o_custkey - o_custkey % 10 NOT IN (SELECT o_custkey - o_custkey % 10 FROM s)
UNION ALL SELECT * FROM s
""",
)
def overwrite_dynamic_int_range(t):
    source = t.orders.where("o_orderdate >= TIMESTAMP_NTZ '2001-06-01 00:00:00'").withColumn(
        "o_orderstatus", F.lit("R")
    )
    return insert_overwrite(t.orders, source, CUSTOMER_RANGE)


LISTED_DAYS = [datetime.datetime(2024, 1, d) for d in (5, 6, 7)]
LISTED = "ts >= TIMESTAMP_NTZ '2024-01-06 00:00:00' AND ts < TIMESTAMP_NTZ '2024-01-09 00:00:00'"


@query(
    "overwrite_static",
    f"""
SELECT {COLUMNS} FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08')
UNION ALL {RELOADED} WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-09'
""",
)
def overwrite_static(t):
    return insert_overwrite(t.events, reloaded(t, LISTED), DAY, partitions=LISTED_DAYS)


@query(
    "overwrite_copy_static",
    f"""
SELECT {COLUMNS} FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08')
UNION ALL {RELOADED} WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-08'
""",
)
def overwrite_copy_static(t):
    return insert_overwrite(t.events, reloaded(t, LISTED), DAY, partitions=LISTED_DAYS, copy=True)


@query(
    "overwrite_copy_dynamic",
    f"""
SELECT {COLUMNS} FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-09')
UNION ALL {RELOADED} WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-09'
""",
)
def overwrite_copy_dynamic(t):
    return insert_overwrite(t.events, reloaded(t, LISTED), DAY, copy=True)


def peak_days(t):
    """The day of the largest value of each event type."""
    peaks = t.events.groupBy("event_type").agg(F.max_by("ts", "value").alias("ts"))
    return peaks.select(F.col("ts").cast("date").alias("dt")).distinct()


@query(
    "overwrite_param_buckets",
    f"""
SELECT {COLUMNS} FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(arg_max(ts, value) AS DATE) FROM events GROUP BY event_type)
UNION ALL {RELOADED} WHERE CAST(ts AS DATE) IN (SELECT CAST(arg_max(ts, value) AS DATE) FROM events GROUP BY event_type)
""",
)
def overwrite_param_buckets(t):
    return overwrite_buckets(t.events, reloaded(t, "true"), DAY, peak_days(t), "dt")


@query(
    "microbatch_day",
    f"""
SELECT {COLUMNS} FROM events WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-16'
UNION ALL {RELOADED} WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-16'
""",
)
def microbatch_day(t):
    begin, end = datetime.datetime(2024, 1, 10, 3), datetime.datetime(2024, 1, 15, 7)
    return microbatch(t.events, reloaded(t, "true"), "ts", "day", begin, end, DAY)


@query(
    "event_time_filter",
    f"SELECT {COLUMNS} FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12 12:00:00'",
)
def event_time_window(t):
    return event_time_filter(t.events, "ts", "2024-01-10 00:00:00", "2024-01-12 12:00:00")


@query(
    "max_partition_filter",
    """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2001-01-01')
""",
)
def max_partition_filter(t):
    target = t.orders.where("o_orderstatus = 'F' AND o_orderdate < TIMESTAMP_NTZ '2001-01-01 00:00:00'")
    return after_max_partition(t.orders, target, "o_orderdate").select("o_orderkey", "o_orderdate")


@query(
    "partition_bucket_time",
    """
SELECT date_trunc('hour', ts)::TIMESTAMP AS h, date_trunc('day', ts)::TIMESTAMP AS d,
       date_trunc('month', ts)::TIMESTAMP AS m, date_trunc('year', ts)::TIMESTAMP AS y, count(*) AS n
FROM events GROUP BY ALL
""",
)
def partition_bucket_time(t):
    spec = {g: PartitionSpec("ts", "datetime", g) for g in ("hour", "day", "month", "year")}
    return t.events.groupBy(
        spec["hour"].bucket_expr().alias("h"),
        spec["day"].bucket_expr().alias("d"),
        spec["month"].bucket_expr().alias("m"),
        spec["year"].bucket_expr().alias("y"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "partition_bucket_int",
    """
SELECT v - (v - 7) % 100 AS bucket, count(*) AS n
FROM (SELECT o_custkey - 300 AS v FROM orders) GROUP BY ALL
""",
)
def partition_bucket_int(t):
    spec = PartitionSpec("v", "int64", range=IntRange(7, 1_000_000, 100))
    values = t.orders.select((F.col("o_custkey") - 300).alias("v"))
    return values.groupBy(spec.bucket_expr().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_partition_id",
    """
SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS h, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%Y-%m-01') AS m,
       strftime(ts, '%Y-01-01') AS y, count(*) AS n
FROM events GROUP BY ALL
""",
)
def partition_id(t):
    spec = {g: PartitionSpec("ts", "datetime", g) for g in ("hour", "day", "month", "year")}
    return t.events.groupBy(
        spec["hour"].id_expr().alias("h"),
        spec["day"].id_expr().alias("d"),
        spec["month"].id_expr().alias("m"),
        spec["year"].id_expr().alias("y"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "ingestion_time_partition",
    """
SELECT event_id, user_id, event_type, value, props, ts AS partition_time FROM events
""",
)
def ingestion_time_partition(t):
    spec = PartitionSpec("ts", "timestamp", "hour", ingestion_time=True)
    wrapped = spec.with_ingestion_time(t.events)
    return wrapped.select(
        "event_id", "user_id", "event_type", "value", "props",
        spec.column().cast("timestamp_ntz").alias("partition_time"),
    )


@query(
    "partitions_metadata",
    "SELECT strftime(ts, '%Y-%m-%d') AS partition_id, count(*) AS row_count FROM events GROUP BY ALL",
)
def partitions_metadata(t):
    return partition_rows(t.events, DAY)
