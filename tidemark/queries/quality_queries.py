"""Data tests, table differences, freshness, catalog report and aggregates."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidemark.functions import aggregate
from tidemark.operators import catalog, ledger, quality
from tidemark.operators.partition import literal
from tidemark.queries.registry import query
from tidemark.sources.loads import preview


@query(
    "test_unique",
    "SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
)
def test_unique(t):
    return quality.unique(t.lineitem, "l_orderkey")


@query("test_not_null", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE o_orderstatus = 'P'")
def test_not_null(t):
    rows = t.orders.select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"))
    return quality.not_null(rows, "status")


@query(
    "test_accepted_values",
    """
SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority
""",
)
def test_accepted_values(t):
    return quality.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    "test_relationships",
    """
SELECT o_custkey AS from_field FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 9000)
""",
)
def test_relationships(t):
    return quality.relationships(t.orders, "o_custkey", t.customer.where("c_acctbal < 9000"), "c_custkey")


@query(
    "test_singular",
    """
SELECT count(*) AS failures, CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END AS status
FROM lineitem WHERE l_discount > 0.09 AND l_quantity < 2
""",
)
def test_singular(t):
    return quality.singular(t.lineitem.where("l_discount > 0.09 AND l_quantity < 2"))


STATES = """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 5000),
b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 199000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
      FROM orders WHERE o_totalprice < 195000 OR o_totalprice > 199000)
"""


def two_states(t):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    a = t.orders.where("o_totalprice > 5000").select(columns)
    b = (
        t.orders.where("o_totalprice < 195000 OR o_totalprice > 199000")
        .withColumn("o_orderstatus", F.expr("CASE WHEN o_totalprice > 199000 THEN 'X' ELSE o_orderstatus END"))
        .select(columns)
    )
    return a, b


relation_diff_sql = (
    STATES
    + """
SELECT (SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS row_count_difference,
       (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
       + (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS num_mismatched
"""
)


@query("relation_diff", relation_diff_sql)
def relation_diff(t):
    return quality.relation_diff(*two_states(t))


@query(
    "row_differences",
    STATES
    + """
SELECT *, 'a' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT *, 'b' AS only_in FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
""",
)
def row_differences(t):
    return quality.row_differences(*two_states(t))


@query(
    "freshness_column",
    """
WITH s AS (
  SELECT 'events' AS source, max(ts) AS max_loaded_at FROM events
  UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
  UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
)
SELECT source, max_loaded_at, epoch_us(TIMESTAMP '2024-01-31 12:00:00' - max_loaded_at) / 1000000.0 AS age_seconds,
       CASE WHEN epoch_us(TIMESTAMP '2024-01-31 12:00:00' - max_loaded_at) / 1000000.0 > 86400 THEN 'error'
            WHEN epoch_us(TIMESTAMP '2024-01-31 12:00:00' - max_loaded_at) / 1000000.0 > 36000 THEN 'warn'
            ELSE 'pass' END AS status
FROM s
""",
)
def freshness_column(t):
    fresh = quality.freshness(
        {"events": t.events, "orders": t.orders, "lineitem": t.lineitem},
        literal(datetime.datetime(2024, 1, 31, 12)),
        loaded_at={"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"},
        warn_after=36_000,
        error_after=86_400,
    )
    return fresh.select("source", "max_loaded_at", "age_seconds", "status")


@query(
    "freshness_files",
    "SELECT unnest(['events', 'orders']) AS source, 'error' AS status, TRUE AS known",
)
def freshness_files(t):
    """Files are older than a day by the end of the century, whenever they were written."""
    found = quality.freshness(
        {"events": t.events, "orders": t.orders}, literal(datetime.datetime(2100, 1, 1)), warn_after=3_600, error_after=86_400
    )
    return found.select("source", "status", F.col("max_loaded_at").isNotNull().alias("known"))


# catalog: events as daily shards, one table per customer segment, columns of the real schemas

SHARDS = """
tables AS (
  SELECT 'raw' AS table_schema, 'events_' || strftime(ts, '%Y%m%d') AS shard_name, 'table' AS table_type,
         sum(length(props))::BIGINT AS size_bytes, count(*) AS row_count
  FROM events GROUP BY ALL
  UNION ALL
  SELECT 'core', lower(c_mktsegment), 'table', sum(length(c_name))::BIGINT, count(*) FROM customer GROUP BY ALL
),
shards AS (
  SELECT *, CASE WHEN regexp_matches(shard_name, '^.+[0-9]{8}$') THEN regexp_extract(shard_name, '^(.+)[0-9]{8}$', 1)
                 ELSE shard_name END AS table_name,
         nullif(regexp_extract(shard_name, '^.+([0-9]{8})$', 1), '') AS shard_index
  FROM tables
),
stats AS (
  SELECT table_schema, table_name, max(shard_name) AS latest_shard_name, min(shard_index) AS shard_min,
         max(shard_index) AS shard_max, count(shard_index) AS shard_count,
         sum(size_bytes)::BIGINT AS size_bytes, sum(row_count)::BIGINT AS row_count
  FROM shards GROUP BY ALL
)
"""


def table_rows(t):
    raw = t.events.groupBy(
        F.lit("raw").alias("table_schema"),
        F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd")).alias("shard_name"),
        F.lit("table").alias("table_type"),
    ).agg(F.sum(F.length("props")).alias("size_bytes"), F.count(F.lit(1)).alias("row_count"))
    core = t.customer.groupBy(
        F.lit("core").alias("table_schema"),
        F.lower("c_mktsegment").alias("shard_name"),
        F.lit("table").alias("table_type"),
    ).agg(F.sum(F.length("c_name")).alias("size_bytes"), F.count(F.lit(1)).alias("row_count"))
    return raw.unionByName(core)


@query("agg_shard_stats", f"WITH {SHARDS} SELECT * FROM stats")
def agg_shard_stats(t):
    return catalog.shard_stats(catalog.table_shards(table_rows(t)))


# every shard has the same four column paths
PATHS = """
paths AS (SELECT * FROM (VALUES
  ('ts', 'timestamp_ntz', 1, TRUE, 2), ('user', 'struct', 2, FALSE, NULL), ('user.id', 'bigint', 2, FALSE, NULL),
  ('kind', 'string', 3, FALSE, 1)) v(column_name, column_type, ordinal_position, is_partitioning_column, clustering_ordinal_position)),
columns AS (
  SELECT s.table_schema, s.shard_name, p.*,
         row_number() OVER (PARTITION BY s.table_schema, s.shard_name ORDER BY p.ordinal_position, p.column_name) AS column_index
  FROM tables s CROSS JOIN paths p WHERE s.table_schema = 'raw'
)
"""


def column_rows(t):
    entry = "struct<column_name: string, column_type: string, ordinal_position: int, is_partitioning_column: boolean, clustering_ordinal_position: int>"
    paths = F.lit(
        '[{"column_name":"ts","column_type":"timestamp_ntz","ordinal_position":1,"is_partitioning_column":true,"clustering_ordinal_position":2},'
        '{"column_name":"user","column_type":"struct","ordinal_position":2,"is_partitioning_column":false},'
        '{"column_name":"user.id","column_type":"bigint","ordinal_position":2,"is_partitioning_column":false},'
        '{"column_name":"kind","column_type":"string","ordinal_position":3,"is_partitioning_column":false,"clustering_ordinal_position":1}]'
    )
    raw = table_rows(t).where("table_schema = 'raw'")
    return raw.select(
        "table_schema", "shard_name", F.inline(F.from_json(paths, f"array<{entry}>"))
    )


@query(
    "window_column_index",
    f"WITH {SHARDS}, {PATHS} SELECT table_schema, shard_name, column_name, column_index FROM columns",
)
def window_column_index(t):
    return catalog.column_index(column_rows(t)).select(
        "table_schema", "shard_name", "column_name", "column_index"
    )


@query(
    "join_catalog_left",
    f"""
WITH {SHARDS}, {PATHS}
SELECT s.table_schema, s.shard_name, coalesce(c.column_name, '<unknown>') AS column_name, s.row_count
FROM shards s LEFT JOIN columns c ON c.table_schema = s.table_schema AND c.shard_name = s.shard_name
""",
)
def join_catalog_left(t):
    shards = catalog.table_shards(table_rows(t))
    return shards.join(column_rows(t), ["table_schema", "shard_name"], "left").select(
        "table_schema",
        "shard_name",
        F.coalesce("column_name", F.lit(catalog.UNKNOWN)).alias("column_name"),
        "row_count",
    )


@query(
    "catalog_report",
    f"""
WITH {SHARDS}, {PATHS}
SELECT st.table_schema, CASE WHEN st.shard_count > 0 THEN st.table_name || '*' ELSE st.table_name END AS table_name,
       coalesce(c.column_name, '<unknown>') AS column_name, coalesce(c.column_index, 1) AS column_index,
       coalesce(c.column_type, '<unknown>') AS column_type, st.shard_count, st.shard_min, st.shard_max,
       st.row_count, st.size_bytes,
       CASE WHEN st.table_schema = 'raw' THEN TRUE END AS is_partitioned,
       CASE WHEN st.table_schema = 'raw' THEN 'ts' END AS partition_column,
       CASE WHEN st.table_schema = 'raw' THEN 'kind, ts' END AS clustering_columns
FROM stats st LEFT JOIN columns c ON c.table_schema = st.table_schema AND c.shard_name = st.latest_shard_name
""",
)
def catalog_report(t):
    report = catalog.catalog_report(table_rows(t), column_rows(t))
    return report.select(
        "table_schema", "table_name", "column_name", "column_index", "column_type", "shard_count", "shard_min",
        "shard_max", "row_count", "size_bytes", "is_partitioned", "partition_column", "clustering_columns",
    )


# aggregates and set operations


@query(
    "agg_ordered_list",
    """
SELECT o_custkey, string_agg(nullif(o_orderstatus, 'P'), ', ' ORDER BY o_orderkey) AS statuses
FROM orders GROUP BY o_custkey
""",
)
def agg_ordered_list(t):
    status = F.expr("nullif(o_orderstatus, 'P')")
    listed = aggregate.array_agg_ordered(status, F.col("o_orderkey"))
    joined = F.when(F.count(status) > 0, F.array_join(listed, ", "))
    return t.orders.groupBy("o_custkey").agg(joined.alias("statuses"))


@query(
    "listagg_ordered",
    "SELECT l_orderkey, string_agg(l_partkey::VARCHAR, '_|_' ORDER BY l_partkey) AS parts FROM lineitem GROUP BY l_orderkey",
)
def listagg_ordered(t):
    """A list holds its whole group, so it is made for groups that stay small, the lines of an order."""
    parts = aggregate.listagg(F.col("l_partkey").cast("string"), "_|_", F.col("l_partkey"))
    return t.lineitem.groupBy("l_orderkey").agg(parts.alias("parts"))


@query(
    "listagg_limit",
    """
SELECT l_suppkey, string_agg(l_orderkey::VARCHAR, ',' ORDER BY n) AS listed
FROM (SELECT l_suppkey, l_orderkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey) AS n
      FROM lineitem)
WHERE n <= 3 GROUP BY l_suppkey
""",
)
def listagg_limit(t):
    return aggregate.listagg_limit(t.lineitem, ["l_suppkey"], "l_orderkey", ["l_shipdate"], 3)


@query(
    "bool_or_agg",
    "SELECT o_custkey, bool_or(o_totalprice > 190000) AS has_large, bool_or(nullif(o_orderstatus, 'F') = 'P') AS has_p FROM orders GROUP BY ALL",
)
def bool_or_agg(t):
    return t.orders.groupBy("o_custkey").agg(
        aggregate.bool_or(F.col("o_totalprice") > 190000).alias("has_large"),
        aggregate.bool_or(F.expr("nullif(o_orderstatus, 'F') = 'P'")).alias("has_p"),
    )


@query(
    "any_value_agg",
    "SELECT n_regionkey, any_value(r_name) AS r_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
)
def any_value_agg(t):
    placed = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return placed.groupBy("n_regionkey").agg(
        aggregate.any_value("r_name").alias("r_name"), F.count(F.lit(1)).alias("n")
    )


@query(
    "array_agg_distinct",
    "SELECT user_id, coalesce(string_agg(DISTINCT nullif(event_type, 'view'), ',' ORDER BY nullif(event_type, 'view')), '') AS kinds FROM events GROUP BY ALL",
)
def array_agg_distinct(t):
    kinds = aggregate.array_agg_distinct(F.expr("nullif(event_type, 'view')"))
    return t.events.groupBy("user_id").agg(F.array_join(kinds, ",").alias("kinds"))


@query(
    "set_except",
    "SELECT l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'",
)
def set_except(t):
    return aggregate.except_distinct(
        t.lineitem.where("l_returnflag = 'A'").select("l_partkey", "l_linenumber"),
        t.lineitem.where("l_returnflag = 'R'").select("l_partkey", "l_linenumber"),
    )


@query(
    "set_intersect",
    "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'",
)
def set_intersect(t):
    return aggregate.intersect_distinct(
        t.lineitem.where("l_returnflag = 'A'").select("l_partkey"),
        t.lineitem.where("l_returnflag = 'R'").select("l_partkey"),
    )


@query("show_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def show_limit(t):
    ranked = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return preview(ranked, 10)


@query(
    "given_rows_test",
    """
SELECT c_mktsegment AS segment, count(*) AS n, 'a' AS only_in FROM customer GROUP BY ALL
UNION ALL SELECT unnest(['AUTOMOBILE', 'NOBODY']), 0, 'b'
""",
)
def given_rows_test(t):
    """A model's output against given rows: counts by segment, of which none is 0."""
    counts = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return quality.equal_rows(counts, [("AUTOMOBILE", 0), ("NOBODY", 0)], "segment string, n bigint")


@query(
    "recent_runs_clamped",
    "SELECT event_id AS run_id, ts AS started_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 500",
)
def recent_runs_clamped(t):
    """A report of recent runs takes 1 to 500 of them, whatever is asked for."""
    runs = t.events.select(F.col("event_id").alias("run_id"), F.struct("ts", "event_id").alias("started_at"))
    return ledger.recent_runs(runs, 10_000).select("run_id", F.col("started_at.ts").alias("started_at"))
