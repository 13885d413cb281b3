"""Schema evolution, nested columns and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import schema
from tidemark.operators.merge import merge
from tidemark.operators.quality import enforce_contract
from tidemark.queries.registry import query

FLAT = ["c_custkey", "c_name", "c_nationkey"]


def narrow(t):
    return t.customer.where("c_acctbal < 5000").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def wide(t):
    return t.customer.where("c_acctbal >= 0").select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_acctbal"
    )


def _merged(t, mode):
    target = schema.evolve(narrow(t), wide(t).schema, mode)
    dest = [c for c in target.columns if c in wide(t).columns]
    return merge(target, wide(t), "c_custkey", dest_columns=dest)


PAIR = """
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 5000),
s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_acctbal >= 0)
"""


@query(
    "schema_ignore",
    PAIR
    + """
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
       coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey, t.c_mktsegment
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""",
)
def schema_ignore(t):
    return _merged(t, "ignore")


@query(
    "schema_append",
    PAIR
    + """
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
       coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey, t.c_mktsegment, s.c_acctbal
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""",
)
def schema_append(t):
    return _merged(t, "append_new_columns")


@query(
    "schema_sync",
    PAIR
    + """
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
       CAST(coalesce(s.c_nationkey, t.c_nationkey) AS VARCHAR) AS c_nationkey, s.c_acctbal
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""",
)
def schema_sync(t):
    return _merged(t, "sync_all_columns")


def nested(t, *extra):
    """Customers with a struct of details, NULL for the poorest; ``extra`` fields inside it."""
    inner = F.struct(F.col("c_mktsegment").alias("segment"), *[f for f in extra if f is not None])
    payload = F.struct(F.col("c_name").alias("name"), inner.alias("market"))
    return t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= -900, payload).alias("payload"))


@query(
    "schema_struct_append",
    """
SELECT c_custkey, c_acctbal >= -900 AS present,
       CASE WHEN c_acctbal >= -900 THEN c_name END AS name,
       CASE WHEN c_acctbal >= -900 THEN c_mktsegment END AS segment,
       CASE WHEN c_acctbal >= 5000 THEN c_nationkey END AS nation
FROM customer
""",
)
def schema_struct_append(t):
    target = nested(t)
    source = nested(t, F.col("c_nationkey").alias("nation")).join(
        t.customer.where("c_acctbal >= 5000").select("c_custkey"), "c_custkey", "left_semi"
    )
    grown = merge(schema.evolve(target, source.schema, "append_new_columns"), source, "c_custkey")
    return grown.select(
        "c_custkey",
        F.col("payload").isNotNull().alias("present"),
        F.col("payload.name").alias("name"),
        F.col("payload.market.segment").alias("segment"),
        F.col("payload.market.nation").alias("nation"),
    )


@query(
    "columns_flatten",
    """
SELECT c_custkey, CASE WHEN c_acctbal >= -900 THEN c_name END AS "payload.name",
       CASE WHEN c_acctbal >= -900 THEN c_mktsegment END AS "payload.market.segment"
FROM customer
""",
)
def columns_flatten(t):
    return schema.flatten(nested(t))


@query(
    "columns_nest",
    """
SELECT c_custkey, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation,
       '{"name":"' || c_name || '","market":{"segment":"' || c_mktsegment || '","nation":' || c_nationkey || '}}' AS doc
FROM customer
""",
)
def columns_nest(t):
    flat = t.customer.select(
        "c_custkey",
        F.col("c_name").alias("payload.name"),
        F.col("c_mktsegment").alias("payload.market.segment"),
        F.col("c_nationkey").alias("payload.market.nation"),
    )
    return schema.nest(flat).select(
        "c_custkey",
        F.col("payload.name").alias("name"),
        F.col("payload.market.segment").alias("segment"),
        F.col("payload.market.nation").alias("nation"),
        F.to_json("payload").alias("doc"),
    )


@query(
    "contract_struct_reorder",
    """
SELECT c_custkey, CASE WHEN c_acctbal >= -900 THEN
       '{"market":{"segment":"' || c_mktsegment || '"},"name":"' || c_name || '"}' END AS doc
FROM customer
""",
)
def contract_struct_reorder(t):
    declared = "payload struct<market: struct<segment: string>, name: string>, c_custkey bigint"
    return enforce_contract(nested(t), declared).select("c_custkey", F.to_json("payload").alias("doc"))


@query("contract_enforce", "SELECT c_custkey, c_acctbal, c_name FROM customer")
def contract_enforce(t):
    declared = T.StructType.fromDDL("c_custkey bigint, c_acctbal double, c_name string")
    rows = t.customer.select("c_name", "c_custkey", "c_acctbal")
    return enforce_contract(rows, declared, not_null=["c_custkey", "c_name"], primary_key=["c_custkey"])


@query(
    "alter_column_type",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def alter_column_type(t):
    return schema.alter_column_type(t.orders, "o_custkey", "string")


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def drop_columns(t):
    return schema.drop_columns(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("add_columns", "SELECT *, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS BIGINT) AS score FROM supplier")
def add_columns(t):
    return schema.add_columns(t.supplier, {"note": "string", "score": "bigint"})
