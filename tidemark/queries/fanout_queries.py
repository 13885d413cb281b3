"""One query for many parameter sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.fanout import fan_out, overwrite_params, params_from
from tidemark.operators.partition import PartitionSpec
from tidemark.queries.registry import query


@query(
    "fanout_param_join",
    """
SELECT p.priority, p.floor::DOUBLE AS floor, o.o_orderstatus, count(*) AS n, sum(o.o_totalprice::DECIMAL(18,2))::DOUBLE AS total
FROM orders o
JOIN (VALUES ('1-URGENT', 1000.0), ('1-URGENT', 100000.0), ('5-LOW', 50000.0)) p(priority, floor)
  ON o.o_orderpriority = p.priority AND o.o_totalprice >= p.floor
GROUP BY ALL
""",
)
def fanout_param_join(t):
    params = params_from(
        t.spark,
        values=[
            {"priority": "1-URGENT", "floor": 1000},
            {"priority": "1-URGENT", "floor": 100000},
            {"priority": "5-LOW", "floor": 50000},
        ],
        types={"floor": "double"},
    )

    def on():
        return (F.col("query.o_orderpriority") == F.col("params.priority")) & (
            F.col("query.o_totalprice") >= F.col("params.floor")
        )

    return (
        fan_out(t.orders, params, on)
        .groupBy("priority", "floor", "o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


@query(
    "fanout_from_relation",
    """
SELECT c.c_mktsegment AS segment, n.n_name AS nation, count(*) AS n
FROM customer c JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3) n ON c.c_nationkey = n.n_nationkey
GROUP BY ALL
""",
)
def fanout_from_relation(t):
    params = params_from(t.spark, relation=t.nation.where("n_regionkey < 3").select("n_nationkey", "n_name"))
    matched = fan_out(t.customer, params, {"c_nationkey": "n_nationkey"})
    return matched.groupBy(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "join_param_fanout",
    """
SELECT p.user_id, p.since, count(*) AS later, max(e.value) AS top
FROM (SELECT user_id, max(ts) - INTERVAL 2 DAY AS since FROM events GROUP BY user_id) p
JOIN events e ON e.user_id = p.user_id AND e.ts >= p.since
GROUP BY ALL
""",
)
def join_param_fanout(t):
    params = params_from(
        t.spark,
        relation=t.events.groupBy("user_id").agg((F.max("ts") - F.expr("INTERVAL 2 DAY")).alias("since")),
    )

    def on():
        return (F.col("query.user_id") == F.col("params.user_id")) & (F.col("query.ts") >= F.col("params.since"))

    return (
        fan_out(t.events, params, on)
        .groupBy("params.user_id", "since")
        .agg(F.count(F.lit(1)).alias("later"), F.max("value").alias("top"))
    )


@query(
    "fanout_dedupe_buckets",
    """
SELECT strftime(dt, '%Y-%m-%d %H:00:00') AS partition_id, min(strftime(dt, '%Y-%m-%d %H:%M:%S')) AS dt
FROM (SELECT date_trunc('second', ts) AS dt FROM events) GROUP BY ALL
""",
)
def fanout_dedupe_buckets(t):
    params = t.events.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("dt"))
    return overwrite_params(params, PartitionSpec("ts", "datetime", "hour"))
