"""Type-2 snapshots of the customers over two or three runs."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidemark.operators.partition import literal
from tidemark.operators.snapshot import snapshot
from tidemark.plans.snapshots import snapshot_table
from tidemark.queries.registry import query
from tidemark.queries.table_queries import table
from tidemark.session import stage
from tidemark.sources import tables

FIRST = datetime.datetime(2024, 1, 1)
SECOND = datetime.datetime(2024, 1, 2)
THIRD = datetime.datetime(2024, 1, 3)

OUT = ["c_custkey", "c_acctbal", "c_mktsegment", "row_id", "valid_from", "valid_to"]


def stamp(moment):
    return literal(moment)


def base(t):
    return t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")


def first_state(t):
    """Customers outside the machinery segment, as of the first run."""
    return base(t).where("c_mktsegment <> 'MACHINERY'").withColumn("updated_at", stamp(FIRST))


def second_state(t):
    """All customers but rich builders; those with debts were updated since."""
    indebted = F.col("c_acctbal") < 0
    return (
        base(t)
        .where("NOT (c_mktsegment = 'BUILDING' AND c_acctbal > 5000)")
        .withColumns(
            {
                "c_acctbal": F.when(indebted, F.col("c_acctbal") + 1000).otherwise(F.col("c_acctbal")),
                "updated_at": F.when(indebted, stamp(SECOND)).otherwise(stamp(FIRST)),
            }
        )
    )


SQL = """
WITH one AS (
  SELECT c_custkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-01' AS updated_at
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
),
two AS (
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
         CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS updated_at
  FROM customer WHERE NOT (c_mktsegment = 'BUILDING' AND c_acctbal > 5000)
)
"""
HASH = "md5({key} || '|' || strftime({at}, '%Y-%m-%d %H:%M:%S')) AS row_id"


def versions(gone):
    """Old versions with their end, then the new versions; ``gone`` ends a vanished key."""
    return SQL + f"""
SELECT one.c_custkey, one.c_acctbal, one.c_mktsegment, {HASH.format(key='one.c_custkey', at='one.updated_at')},
       one.updated_at AS valid_from,
       CASE WHEN two.c_custkey IS NULL THEN {gone}
            WHEN two.updated_at > one.updated_at THEN two.updated_at END AS valid_to
FROM one LEFT JOIN two USING (c_custkey)
UNION ALL
SELECT two.c_custkey, two.c_acctbal, two.c_mktsegment, {HASH.format(key='two.c_custkey', at='two.updated_at')},
       two.updated_at, NULL
FROM two LEFT JOIN one USING (c_custkey)
WHERE one.c_custkey IS NULL OR two.updated_at > one.updated_at
"""


def two_runs(t, **options):
    common = {"strategy": "timestamp", "updated_at": "updated_at", **options}
    first = snapshot(None, first_state(t), "c_custkey", now=FIRST, **common)
    return snapshot(first, second_state(t), "c_custkey", now=SECOND, **common)


@query("snapshot_timestamp", versions("CAST(NULL AS TIMESTAMP)"))
def snapshot_timestamp(t):
    return two_runs(t).select(OUT)


@query("snapshot_invalidate", versions("TIMESTAMP '2024-01-02'"))
def snapshot_invalidate(t):
    return two_runs(t, hard_deletes="invalidate").select(OUT)


@query("snapshot_table_runs", versions("TIMESTAMP '2024-01-02'"))
def snapshot_table_runs(t):
    name = table(t, "snapshot_runs")
    options = {"strategy": "timestamp", "updated_at": "updated_at", "hard_deletes": "invalidate"}
    for state, moment in ((first_state(t), FIRST), (second_state(t), SECOND), (second_state(t), THIRD)):
        snapshot_table(t.spark, name, state, "c_custkey", now=moment, **options)
    return tables.read_table(t.spark, name).select(OUT)


@query(
    "snapshot_check",
    SQL
    + f"""
SELECT one.c_custkey, one.c_acctbal, one.c_mktsegment,
       {HASH.format(key='one.c_custkey', at="TIMESTAMP '2024-01-01'")}, TIMESTAMP '2024-01-01' AS valid_from,
       CASE WHEN two.c_custkey IS NOT NULL AND two.c_acctbal IS DISTINCT FROM one.c_acctbal
            THEN TIMESTAMP '2024-01-02' END AS valid_to
FROM one LEFT JOIN two USING (c_custkey)
UNION ALL
SELECT two.c_custkey, two.c_acctbal, two.c_mktsegment,
       {HASH.format(key='two.c_custkey', at="TIMESTAMP '2024-01-02'")}, TIMESTAMP '2024-01-02', NULL
FROM two LEFT JOIN one USING (c_custkey)
WHERE one.c_custkey IS NULL OR two.c_acctbal IS DISTINCT FROM one.c_acctbal
""",
)
def snapshot_check(t):
    options = {"strategy": "check", "check_cols": ["c_acctbal", "c_mktsegment"]}
    first = snapshot(None, first_state(t), "c_custkey", now=FIRST, **options)
    return snapshot(first, second_state(t), "c_custkey", now=SECOND, **options).select(OUT)


@query(
    "snapshot_new_record",
    f"""
SELECT c_custkey, c_acctbal, c_mktsegment, row_id, valid_from, valid_to, 'False' AS is_deleted
FROM ({versions("TIMESTAMP '2024-01-02'")})
UNION ALL
SELECT c_custkey, c_acctbal, c_mktsegment,
       md5(md5(c_custkey || '|2024-01-01 00:00:00') || '|2024-01-02 00:00:00'),
       TIMESTAMP '2024-01-02', NULL, 'True'
FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000
""",
)
def snapshot_new_record(t):
    return two_runs(t, hard_deletes="new_record").select(*OUT, "is_deleted")


@query(
    "snapshot_revive",
    f"""
SELECT * FROM ({versions("TIMESTAMP '2024-01-02'")})
UNION ALL
SELECT c_custkey, c_acctbal, c_mktsegment, {HASH.format(key='c_custkey', at="TIMESTAMP '2024-01-01'")},
       TIMESTAMP '2024-01-01', NULL
FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000
""",
)
def snapshot_revive(t):
    options = {"strategy": "timestamp", "updated_at": "updated_at", "hard_deletes": "invalidate"}
    second = stage(two_runs(t, hard_deletes="invalidate"), "snapshot")
    again = second_state(t).unionByName(
        first_state(t).where("c_mktsegment = 'BUILDING' AND c_acctbal > 5000")
    )
    return snapshot(second, again, "c_custkey", now=THIRD, **options).select(OUT)


@query(
    "snapshot_revive_marked",
    f"""
SELECT c_custkey, c_acctbal, c_mktsegment, row_id, valid_from, valid_to, 'False' AS is_deleted
FROM ({versions("TIMESTAMP '2024-01-02'")})
UNION ALL
SELECT c_custkey, c_acctbal, c_mktsegment,
       md5(md5(c_custkey || '|2024-01-01 00:00:00') || '|2024-01-02 00:00:00'),
       TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-03', 'True'
FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000
UNION ALL
SELECT c_custkey, c_acctbal, c_mktsegment, md5(c_custkey || '|2024-01-03 00:00:00'),
       TIMESTAMP '2024-01-03', NULL, 'False'
FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000
""",
)
def snapshot_revive_marked(t):
    options = {"strategy": "timestamp", "updated_at": "updated_at", "hard_deletes": "new_record"}
    second = stage(two_runs(t, hard_deletes="new_record"), "snapshot")
    back = first_state(t).where("c_mktsegment = 'BUILDING' AND c_acctbal > 5000")
    again = second_state(t).unionByName(back.withColumn("updated_at", stamp(THIRD)))
    return snapshot(second, again, "c_custkey", now=THIRD, **options).select(*OUT, "is_deleted")


@query(
    "snapshot_new_column",
    f"""
SELECT v.*, CASE WHEN valid_from = TIMESTAMP '2024-01-02' OR c_mktsegment = 'MACHINERY' THEN c_mktsegment END AS segment,
       CASE WHEN valid_from = TIMESTAMP '2024-01-02' OR c_mktsegment = 'MACHINERY' THEN c_custkey END AS detail_key
FROM ({versions("CAST(NULL AS TIMESTAMP)")}) v
""",
)
def snapshot_new_column(t):
    options = {"strategy": "timestamp", "updated_at": "updated_at"}
    first = snapshot(None, first_state(t), "c_custkey", now=FIRST, **options)
    wider = second_state(t).withColumn(
        "detail", F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("key"))
    )
    return snapshot(first, wider, "c_custkey", now=SECOND, **options).select(
        *OUT, F.col("detail.segment").alias("segment"), F.col("detail.key").alias("detail_key")
    )


@query(
    "fn_snapshot_hash",
    """
SELECT c_custkey, md5(c_custkey || '|' || coalesce(nullif(c_mktsegment, 'BUILDING'), '') || '|' || c_name) AS row_id
FROM customer
""",
)
def snapshot_hash(t):
    from tidemark.functions.scalar import snapshot_hash

    segment = F.expr("nullif(c_mktsegment, 'BUILDING')")
    return t.customer.select(
        "c_custkey", snapshot_hash(F.col("c_custkey"), segment, F.col("c_name")).alias("row_id")
    )
