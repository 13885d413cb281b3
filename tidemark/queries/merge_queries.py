"""Merge and delete: the stored state ends in 1998, the load brings 1997 onwards again."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.merge import merge
from tidemark.operators.overwrite import delete_where
from tidemark.operators.partition import PartitionSpec
from tidemark.queries.registry import query

STORED = "o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'"
LOADED = "o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00'"
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def stored(t):
    return t.orders.where(STORED)


def loaded(t):
    return t.orders.where(LOADED).withColumns(
        {
            "o_totalprice": F.col("o_totalprice") * 2,
            "o_orderstatus": F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END"),
        }
    )


def loaded_in_part(t):
    """As ``loaded``, but only urgent orders carry a new price."""
    return t.orders.where(LOADED).withColumns(
        {
            "o_totalprice": F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END"),
            "o_orderpriority": F.concat("o_orderpriority", F.lit("!")),
        }
    )


PAIR = """
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
)
"""

PARTIAL_PAIR = """
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority || '!' AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
)
"""


def upserted(updated, pair=PAIR):
    """SQL of a merge by order key where ``updated`` maps columns to their updated value."""
    items = ", ".join(
        f"CASE WHEN s.o_orderkey IS NULL THEN t.{c} WHEN t.o_orderkey IS NULL THEN s.{c} "
        f"ELSE {updated.get(c, f't.{c}')} END AS {c}"
        for c in COLUMNS
    )
    return f"{pair} SELECT {items} FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"


ALL_COLUMNS = {c: f"s.{c}" for c in COLUMNS}


@query("merge_upsert", upserted(ALL_COLUMNS))
def merge_upsert(t):
    return merge(stored(t), loaded(t), "o_orderkey")


@query("merge_append", f"{PAIR} SELECT * FROM t UNION ALL SELECT * FROM s")
def merge_append(t):
    return merge(stored(t), loaded(t), None)


@query("merge_update_columns", upserted({"o_totalprice": "s.o_totalprice"}))
def merge_update_columns(t):
    return merge(stored(t), loaded(t), "o_orderkey", update_columns=["o_totalprice"])


@query("merge_exclude_columns", upserted({k: v for k, v in ALL_COLUMNS.items() if k != "o_orderstatus"}))
def merge_exclude_columns(t):
    return merge(stored(t), loaded(t), "o_orderkey", exclude_columns=["o_orderstatus"])


def _if_price_differs():
    return {
        c: f"CASE WHEN t.o_totalprice IS DISTINCT FROM s.o_totalprice THEN s.{c} ELSE t.{c} END"
        for c in COLUMNS
    }


@query("merge_skip_unchanged", upserted(_if_price_differs(), PARTIAL_PAIR))
def merge_skip_unchanged(t):
    return merge(
        stored(t),
        loaded_in_part(t),
        "o_orderkey",
        skip_unchanged=True,
        unstable_columns=["o_orderpriority"],
    )


@query("merge_skip_unchanged_stable", upserted(_if_price_differs(), PARTIAL_PAIR))
def merge_skip_unchanged_stable(t):
    return merge(
        stored(t),
        loaded_in_part(t),
        "o_orderkey",
        skip_unchanged=True,
        stable_columns=["o_totalprice", "o_custkey"],
    )


@query(
    "merge_predicates",
    PAIR
    + """
SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey AND t.o_orderstatus <> 'F' AND s.o_totalprice > 1000
UNION ALL
SELECT s.* FROM s
WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey AND t.o_orderstatus <> 'F' AND s.o_totalprice > 1000)
""",
)
def merge_predicates(t):
    return merge(
        stored(t),
        loaded(t),
        "o_orderkey",
        predicates=["dest.o_orderstatus <> 'F'", "source.o_totalprice > 1000"],
    )


@query(
    "merge_mixed_predicate",
    PAIR
    + """
SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey AND s.o_totalprice - t.o_totalprice > 100000
UNION ALL
SELECT s.* FROM s
WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey AND s.o_totalprice - t.o_totalprice > 100000)
""",
)
def merge_mixed_predicate(t):
    return merge(
        stored(t), loaded(t), "o_orderkey", predicates=["source.o_totalprice - dest.o_totalprice > 100000"]
    )


LINES = """
WITH base AS (
  SELECT l_orderkey, l_linenumber, sum(l_quantity) AS quantity, max(l_extendedprice) AS price,
         max(l_shipdate) AS shipped
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
t AS (SELECT * FROM base WHERE shipped < TIMESTAMP '1999-01-01'),
s AS (SELECT l_orderkey, l_linenumber, quantity + 100 AS quantity, price, shipped
      FROM base WHERE shipped >= TIMESTAMP '1997-01-01')
"""


@query(
    "merge_composite_key",
    LINES
    + """
SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey,
       coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
       CASE WHEN s.l_orderkey IS NULL THEN t.quantity ELSE s.quantity END AS quantity,
       CASE WHEN s.l_orderkey IS NULL THEN t.price ELSE s.price END AS price,
       CASE WHEN s.l_orderkey IS NULL THEN t.shipped ELSE s.shipped END AS shipped
FROM t FULL OUTER JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
""",
)
def merge_composite_key(t):
    base = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("quantity"),
        F.max("l_extendedprice").alias("price"),
        F.max("l_shipdate").alias("shipped"),
    )
    target = base.where("shipped < TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    source = base.where("shipped >= TIMESTAMP_NTZ '1997-01-01 00:00:00'").withColumn(
        "quantity", F.col("quantity") + 100
    )
    return merge(target, source, ["l_orderkey", "l_linenumber", "l_orderkey"])


def _customers(t):
    keyed = t.customer.withColumn("c_custkey", F.expr("nullif(c_custkey, 0)"))
    return keyed, keyed.where("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)


CUSTOMERS = """
WITH t AS (SELECT nullif(c_custkey, 0) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, TRUE AS hit
      FROM t WHERE c_acctbal > 0)
"""


@query(
    "merge_null_key",
    CUSTOMERS
    + """
SELECT t.c_custkey, t.c_name, t.c_nationkey, CASE WHEN s.hit THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       t.c_mktsegment
FROM t LEFT JOIN s ON t.c_custkey IS NOT DISTINCT FROM s.c_custkey
""",
)
def merge_null_key(t):
    target, source = _customers(t)
    return merge(target, source, "c_custkey", null_safe=True)


@query(
    "merge_null_key_plain",
    CUSTOMERS
    + """
SELECT t.c_custkey, t.c_name, t.c_nationkey, CASE WHEN s.hit THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       t.c_mktsegment
FROM t LEFT JOIN s ON t.c_custkey = s.c_custkey
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM s WHERE c_custkey IS NULL
""",
)
def merge_null_key_plain(t):
    target, source = _customers(t)
    return merge(target, source, "c_custkey")


MOVED = """
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 1 YEAR ELSE o_orderdate END AS o_orderdate,
         o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM s WHERE o_orderdate IS NOT NULL),
inside AS (SELECT * FROM t WHERE CAST(o_orderdate AS DATE) IN (SELECT d FROM days)),
outside AS (SELECT * FROM t WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM days))
"""


def moved(t):
    return t.orders.where(LOADED).withColumns(
        {
            "o_totalprice": F.col("o_totalprice") * 2,
            "o_orderdate": F.expr(
                "CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 1 YEAR ELSE o_orderdate END"
            ),
        }
    )


@query(
    "merge_partition_pruned",
    MOVED
    + """
SELECT * FROM outside
UNION ALL SELECT * FROM s
UNION ALL SELECT * FROM inside WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = inside.o_orderkey)
""",
)
def merge_partition_pruned(t):
    return merge(
        stored(t), moved(t), "o_orderkey", partition=PartitionSpec("o_orderdate", "datetime", "day")
    )


@query(
    "merge_partition_all",
    MOVED
    + """
SELECT * FROM s
UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
""",
)
def merge_partition_all(t):
    return merge(
        stored(t),
        moved(t),
        "o_orderkey",
        partition=PartitionSpec("o_orderdate", "datetime", "day"),
        partition_scope="all",
    )


@query(
    "delete_where",
    "SELECT * FROM orders WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F' AND o_totalprice > 100000, FALSE)",
)
def delete_rows(t):
    return delete_where(t.orders, "nullif(o_orderstatus, 'P') = 'F' AND o_totalprice > 100000")


@query(
    "merge_mixed_repeated_keys",
    """
WITH t AS (SELECT o_orderkey AS k, o_totalprice AS price, 0 AS line FROM orders),
s AS (SELECT l_orderkey AS k, max(l_extendedprice) AS price, l_linenumber AS line FROM lineitem GROUP BY ALL),
best AS (
  SELECT s.*, t.k IS NOT NULL AND s.line = 1 AND s.price > t.price AS hit FROM s LEFT JOIN t USING (k)
)
SELECT t.k, CASE WHEN b.k IS NOT NULL THEN b.price ELSE t.price END AS price,
       CASE WHEN b.k IS NOT NULL THEN b.line ELSE t.line END::INTEGER AS line
FROM t LEFT JOIN (SELECT * FROM best WHERE hit) b USING (k)
UNION ALL SELECT k, price, line::INTEGER FROM best WHERE NOT hit
""",
)
def merge_mixed_repeated_keys(t):
    """Order lines that share a key: the first line updates its order if it costs more, all others are inserted."""
    target = t.orders.selectExpr("o_orderkey AS k", "o_totalprice AS price", "0 AS line")
    source = t.lineitem.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("int").alias("line")).agg(
        F.max("l_extendedprice").alias("price")
    )
    return merge(target, source, "k", predicates=["source.line = 1 + dest.line AND source.price > dest.price"])


@query(
    "merge_repeated_new_keys",
    """
SELECT o_orderkey AS k, CAST(o_custkey AS BIGINT) AS v FROM orders
UNION ALL SELECT -1 - l_orderkey, CAST(l_linenumber AS BIGINT) FROM lineitem
""",
)
def merge_repeated_new_keys(t):
    """Repeated source keys are an error only where they match a target row; these match none."""
    target = t.orders.selectExpr("o_orderkey AS k", "CAST(o_custkey AS BIGINT) AS v")
    source = t.lineitem.selectExpr("-1 - l_orderkey AS k", "CAST(l_linenumber AS BIGINT) AS v")
    return merge(target, source, "k")


@query(
    "merge_dest_columns",
    "SELECT o_orderkey AS k, o_totalprice * 2 AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status FROM orders",
)
def merge_dest_columns(t):
    """Only the listed columns are written: matched rows keep their status, new rows have none."""
    orders = t.orders.selectExpr("o_orderkey AS k", "o_totalprice AS price", "o_orderstatus AS status")
    source = orders.selectExpr("k", "price * 2 AS price", "'?' AS status")
    return merge(orders.where("k % 2 = 0"), source, "k", dest_columns=["k", "price"], update_columns=["price"])
