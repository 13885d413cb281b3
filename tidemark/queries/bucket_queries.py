"""Tables in hash buckets of their key: merged, compared and snapshotted bucket by bucket."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.buckets import KeyBuckets, digests, row_hash
from tidemark.plans.digests import snapshot_stored, stored_diff, stored_relation_diff
from tidemark.plans.incremental import merge_table
from tidemark.queries import change_tracking, quality_queries, snapshot_queries
from tidemark.queries.merge_queries import ALL_COLUMNS, COLUMNS, loaded, stored, upserted
from tidemark.queries.registry import query
from tidemark.queries.table_queries import table
from tidemark.sources import tables

BY_ORDER = KeyBuckets(("o_orderkey",), 32)


@query("merge_key_buckets", upserted(ALL_COLUMNS))
def merge_key_buckets(t):
    """The load arrives in two parts, each of which rewrites the buckets of its keys."""
    name = table(t, "key_buckets")
    tables.create_table_as(stored(t).select(COLUMNS), name, cluster_by=["o_orderkey"], buckets=BY_ORDER)
    early = F.col("o_orderkey") % 1000 == 0
    for part in (loaded(t).where(early), loaded(t).where(~early)):
        merge_table(t.spark, name, part.select(COLUMNS), "o_orderkey")
    return tables.read_table(t.spark, name)


NO_KEYS = """
WITH t AS (SELECT nullif(o_orderkey, (SELECT min(o_orderkey) FROM orders)) AS o_orderkey, o_totalprice FROM orders),
s AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM t WHERE o_orderkey IS NULL OR o_orderkey % 7 = 0)
SELECT t.o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice
FROM t LEFT JOIN s ON t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey
"""


@query("merge_key_buckets_null_safe", NO_KEYS)
def merge_key_buckets_null_safe(t):
    """One order lost its key; a null-safe merge finds it in the bucket of the keys that are NULL."""
    least = t.orders.agg(F.min("o_orderkey").alias("least"))
    rows = t.orders.join(F.broadcast(least), F.col("o_orderkey") == F.col("least"), "left").select(
        F.when(F.col("least").isNull(), F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice"
    )
    name = table(t, "null_keys")
    tables.create_table_as(rows, name, buckets=BY_ORDER)
    source = tables.read_table(t.spark, name).where("o_orderkey IS NULL OR o_orderkey % 7 = 0")
    merge_table(t.spark, name, source.withColumn("o_totalprice", F.col("o_totalprice") * 2), "o_orderkey", null_safe=True)
    return tables.read_table(t.spark, name)


@query("changes_stored_diff", change_tracking.changes_snapshot_diff_sql)
def changes_stored_diff(t):
    names = []
    for state in change_tracking.states(t):
        names.append(table(t, "diff"))
        tables.create_table_as(state, names[-1], buckets=BY_ORDER)
    return stored_diff(t.spark, *names, "o_orderkey").select(
        F.col("_change_type").alias("change_type"), "o_orderkey", "o_totalprice", "o_orderdate"
    )


@query("relation_stored_diff", quality_queries.relation_diff_sql)
def relation_stored_diff(t):
    names = []
    for state in quality_queries.two_states(t):
        names.append(table(t, "relation"))
        tables.create_table_as(state, names[-1], buckets=BY_ORDER)
    return stored_relation_diff(t.spark, *names)


@query("snapshot_stored_runs", snapshot_queries.versions("TIMESTAMP '2024-01-02'"))
def snapshot_stored_runs(t):
    """As ``snapshot_table_runs``, with the source stored in hash buckets and merged before each run."""
    q = snapshot_queries
    name, source = table(t, "snapshot"), table(t, "source")
    options = {"strategy": "timestamp", "updated_at": "updated_at", "hard_deletes": "invalidate"}
    by_customer = KeyBuckets(("c_custkey",), 16)
    for state, moment in ((q.first_state(t), q.FIRST), (q.second_state(t), q.SECOND), (q.second_state(t), q.THIRD)):
        tables.create_table_as(state, source, buckets=by_customer)
        snapshot_stored(t.spark, name, source, "c_custkey", now=moment, **options)
    return tables.read_table(t.spark, name).select(q.OUT)


@query(
    "bucket_digests",
    "SELECT o_orderstatus AS bucket, count(*) AS row_count, count(DISTINCT o_orderkey) AS n_hashes FROM orders GROUP BY o_orderstatus",
)
def bucket_digests(t):
    """Rows of each digest, and different hashes of whole rows: as many as there are orders."""
    counted = digests(t.orders, F.col("o_orderstatus"), t.orders.columns).select("bucket", "row_count")
    hashes = t.orders.select("o_orderstatus", row_hash(t.orders).alias("h")).groupBy("o_orderstatus").agg(
        F.count_distinct("h").alias("n_hashes")
    )
    return counted.join(hashes, F.col("bucket") == F.col("o_orderstatus")).select("bucket", "row_count", "n_hashes")
