"""Scalar functions over whole columns, and user-defined functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import scalar, udf
from tidemark.functions.aggregate import sum_positive
from tidemark.queries.registry import query


@query(
    "equals_null_safe",
    """
SELECT x, y, x IS NOT DISTINCT FROM y AS same, x = y AS plain, count(*) AS n
FROM (SELECT nullif(o_orderstatus, 'F') AS x, nullif(CASE WHEN o_totalprice > 100000 THEN 'P' ELSE 'F' END, 'F') AS y FROM orders)
GROUP BY ALL
""",
)
def equals_null_safe(t):
    pairs = t.orders.select(
        F.expr("nullif(o_orderstatus, 'F')").alias("x"),
        F.expr("nullif(CASE WHEN o_totalprice > 100000 THEN 'P' ELSE 'F' END, 'F')").alias("y"),
    )
    return pairs.groupBy(
        "x", "y", scalar.equals("x", "y").alias("same"), scalar.equals("x", "y", null_safe=False).alias("plain")
    ).agg(F.count(F.lit(1)).alias("n"))


def _joined(array):
    return F.array_join(array, "|")


@query("fn_array_construct", "SELECT p_partkey, p_brand || '|' || p_type || '|new' AS items, '' AS nothing FROM part")
def fn_array_construct(t):
    made = scalar.array_construct(["p_brand", "p_type", F.lit("new")])
    return t.part.select(
        "p_partkey",
        _joined(made).alias("items"),
        _joined(scalar.array_construct([], "string")).alias("nothing"),
    )


@query("fn_array_append", "SELECT p_partkey, p_brand || '|' || p_type || '|' || p_name AS items FROM part")
def fn_array_append(t):
    base = scalar.array_construct(["p_brand", "p_type"])
    return t.part.select("p_partkey", _joined(scalar.array_append(base, "p_name")).alias("items"))


@query("fn_array_concat", "SELECT p_partkey, p_brand || '|' || p_type || '|' || p_name || '|x' AS items FROM part")
def fn_array_concat(t):
    left = scalar.array_construct(["p_brand", "p_type"])
    right = scalar.array_construct(["p_name", F.lit("x")])
    return t.part.select("p_partkey", _joined(scalar.array_concat(left, right)).alias("items"))


@query(
    "fn_current_timestamp",
    "SELECT n_nationkey, TRUE AS known, 1 AS moments, TRUE AS after_data FROM nation",
)
def fn_current_timestamp(t):
    """The moment itself differs from run to run: it is known, one for all rows, and after the data."""
    seen = t.nation.select("n_nationkey", scalar.current_timestamp().alias("seen_at"))
    moments = seen.agg(F.count_distinct("seen_at").cast("int").alias("moments"))  # one row
    newest = t.events.agg(F.max("ts").cast("timestamp").alias("newest"))
    return seen.join(F.broadcast(moments), F.lit(True)).join(F.broadcast(newest), F.lit(True)).select(
        "n_nationkey", F.col("seen_at").isNotNull().alias("known"), "moments",
        (F.col("seen_at") > F.col("newest")).alias("after_data"),
    )


@query(
    "fn_date",
    "SELECT o_orderkey, strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') AS d FROM orders",
)
def fn_date(t):
    first = scalar.make_date(F.year("o_orderdate"), F.month("o_orderdate"), 1)
    return t.orders.select("o_orderkey", first.cast("string").alias("d"))


@query(
    "fn_date_trunc",
    """
SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS h, date_trunc('month', ts)::TIMESTAMP AS m,
       date_trunc('quarter', ts)::TIMESTAMP AS q,
       (date_trunc('day', ts) - to_days(dayofweek(ts)::INTEGER))::TIMESTAMP AS w,
       date_trunc('week', ts)::TIMESTAMP AS iso_w
FROM events
""",
)
def fn_date_trunc(t):
    parts = {"h": "hour", "m": "month", "q": "quarter", "w": "week", "iso_w": "isoweek"}
    return t.events.select(
        "event_id",
        *[scalar.date_trunc(p, "ts").cast("timestamp_ntz").alias(n) for n, p in parts.items()],
    )


@query(
    "fn_dateadd",
    """
SELECT o_orderkey, (o_orderdate + INTERVAL 1 MONTH)::TIMESTAMP AS m, (o_orderdate - INTERVAL 10 DAY)::TIMESTAMP AS d,
       (o_orderdate + INTERVAL 5 HOUR)::TIMESTAMP AS h, (o_orderdate + INTERVAL 2 YEAR)::TIMESTAMP AS y FROM orders
""",
)
def fn_dateadd(t):
    return t.orders.select(
        "o_orderkey",
        scalar.dateadd("month", 1, "o_orderdate").alias("m"),
        scalar.dateadd("day", -10, "o_orderdate").alias("d"),
        scalar.dateadd("hour", 5, "o_orderdate").alias("h"),
        scalar.dateadd("year", 2, "o_orderdate").alias("y"),
    )


LATER = "(ts + to_seconds(CAST(value * 36000 AS BIGINT)))"
PARTS = ["microsecond", "millisecond", "second", "minute", "hour", "day", "month", "quarter", "year"]
MONDAY = "CAST(date_trunc('week', {}) AS DATE)"


@query(
    "fn_datediff",
    "SELECT event_id, "
    + ", ".join(f"date_diff('{p}', ts, {LATER}) AS d_{p}" for p in PARTS)
    + f", ({MONDAY.format(LATER)} - {MONDAY.format('ts')}) // 7 AS d_isoweek"
    + f", ({MONDAY.format(LATER + ' + INTERVAL 1 DAY')} - {MONDAY.format('ts + INTERVAL 1 DAY')}) // 7 AS d_week FROM events",
)
def fn_datediff(t):
    later = F.timestamp_add("SECOND", F.expr("CAST(round(value * 36000) AS INT)"), "ts")
    return t.events.select("event_id", *[scalar.datediff("ts", later, p).alias(f"d_{p}") for p in [*PARTS, "isoweek", "week"]])


@query(
    "fn_last_day",
    """
SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS m,
       strftime(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS q
FROM orders
""",
)
def fn_last_day(t):
    return t.orders.select(
        "o_orderkey",
        scalar.last_day("o_orderdate").cast("string").alias("m"),
        scalar.last_day("o_orderdate", "quarter").cast("string").alias("q"),
    )


@query(
    "fn_timestamp_add",
    "SELECT event_id, ts + INTERVAL 3 HOUR AS later, ts - INTERVAL 2 DAY AS earlier, strftime(ts, '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS parsed FROM events",
)
def fn_timestamp_add(t):
    return t.events.select(
        "event_id",
        scalar.timestamp_add("ts", 3, "hour").alias("later"),
        scalar.timestamp_add("ts", -2, "day").alias("earlier"),
        scalar.string_as_time(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("parsed"),
    )


@query("fn_string_add", "SELECT c_custkey, c_name || '!' AS after_it, 'Mx ' || c_name AS before_it FROM customer")
def fn_string_add(t):
    return t.customer.select(
        "c_custkey",
        scalar.string_add("c_name", "!").alias("after_it"),
        scalar.string_add("c_name", "Mx ", "prepend").alias("before_it"),
    )


@query("fn_concat", "SELECT p_partkey, p_brand || ' ' || p_type AS joined FROM part")
def fn_concat(t):
    return t.part.select("p_partkey", scalar.concat("p_brand", F.lit(" "), "p_type").alias("joined"))


@query("fn_length", "SELECT doc_id, length(text) AS n FROM documents")
def fn_length(t):
    return t.documents.select("doc_id", scalar.length("text").cast("bigint").alias("n"))


@query("fn_replace", "SELECT doc_id, md5(replace(text, 'the', '<T>')) AS h FROM documents")
def fn_replace(t):
    return t.documents.select("doc_id", F.md5(scalar.replace("text", "the", "<T>")).alias("h"))


@query("fn_hash", "SELECT doc_id, md5(doc_id::VARCHAR) AS id_hash, md5(text) AS text_hash FROM documents")
def fn_hash(t):
    return t.documents.select(
        "doc_id", scalar.hash_text("doc_id").alias("id_hash"), scalar.hash_text("text").alias("text_hash")
    )


@query("fn_position", "SELECT doc_id, strpos(text, 'tion') AS at, strpos(text, '') AS start FROM documents")
def fn_position(t):
    return t.documents.select(
        "doc_id", scalar.position("tion", "text").alias("at"), scalar.position("", "text").alias("start")
    )


@query("fn_right", "SELECT doc_id, right(text, 7) AS tail, '' AS nothing FROM documents")
def fn_right(t):
    return t.documents.select(
        "doc_id", scalar.right("text", 7).alias("tail"), scalar.right("text", 0).alias("nothing")
    )


@query(
    "fn_split_part",
    """
SELECT page_id, string_split(url, '/')[3] AS host, string_split(url, '?')[2] AS args,
       string_split(url, '/')[len(string_split(url, '/'))] AS last, string_split(url, '.')[9] AS beyond
FROM pages
""",
)
def fn_split_part(t):
    return t.pages.select(
        "page_id",
        scalar.split_part("url", "/", 3).alias("host"),
        scalar.split_part("url", "?", 2).alias("args"),
        scalar.split_part("url", "/", -1).alias("last"),
        scalar.split_part("url", ".", 9).alias("beyond"),
    )


@query("fn_string_literal", "SELECT n_nationkey, 'it''s \\ \"quoted\"' AS said FROM nation")
def fn_string_literal(t):
    return t.nation.select("n_nationkey", scalar.string_literal('it\'s \\ "quoted"').alias("said"))


@query(
    "fn_safe_cast",
    """
SELECT p_partkey, try_cast(split_part(p_brand, '#', 2) AS BIGINT) AS good, try_cast(p_name AS BIGINT) AS bad,
       coalesce(try_cast(split_part(p_brand, '#', 2) AS BIGINT)::VARCHAR, 'null') || '|null' AS items
FROM part
""",
)
def fn_safe_cast(t):
    digits = scalar.split_part("p_brand", "#", 2)
    items = scalar.safe_cast(F.array(digits, F.col("p_name")), "array<bigint>")
    return t.part.select(
        "p_partkey",
        scalar.safe_cast(digits, "bigint").alias("good"),
        scalar.safe_cast("p_name", "bigint").alias("bad"),
        F.array_join(items.cast("array<string>"), "|", "null").alias("items"),
    )


@query("fn_cast", "SELECT o_orderkey, o_custkey::VARCHAR AS key_text, (o_totalprice > 100000)::VARCHAR AS large FROM orders")
def fn_cast(t):
    return t.orders.select(
        "o_orderkey",
        scalar.cast("o_custkey", "string").alias("key_text"),
        scalar.bool_to_text(F.col("o_totalprice") > 100000).alias("large"),
    )


@query(
    "fn_generate_series",
    """
SELECT g.n AS generated_number, count(l_quantity) AS lines
FROM (SELECT unnest(range(1, 61)) AS n) g LEFT JOIN lineitem ON l_quantity = g.n GROUP BY g.n
""",
)
def fn_generate_series(t):
    numbers = scalar.generate_series(t.spark, 60)
    sizes = t.lineitem.groupBy(F.col("l_quantity").cast("bigint").alias("generated_number")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return numbers.join(sizes, "generated_number", "left").fillna(0, ["lines"])


@query(
    "fn_date_spine",
    """
SELECT d AS date_day, count(event_id) AS n
FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-20', TIMESTAMP '2024-02-09', INTERVAL 1 DAY)) AS d)
LEFT JOIN events ON date_trunc('day', ts) = d
GROUP BY d
""",
)
def fn_date_spine(t):
    spine = scalar.date_spine(t.spark, "day", "2023-12-20", "2024-02-10")
    daily = t.events.groupBy(F.col("ts").cast("date").cast("timestamp_ntz").alias("date_day")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return spine.join(daily, "date_day", "left").select(
        "date_day", F.coalesce("events", F.lit(0)).alias("n")
    )


@query(
    "fn_intervals_between",
    "SELECT user_id, date_diff('day', min(ts), max(ts)) AS days, date_diff('hour', min(ts), max(ts)) AS hours FROM events GROUP BY user_id",
)
def fn_intervals_between(t):
    spans = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return spans.select(
        "user_id",
        scalar.intervals_between("a", "b", "day").alias("days"),
        scalar.intervals_between("a", "b", "hour").alias("hours"),
    )


@query(
    "fn_powers_of_two",
    "SELECT c_nationkey, count(*) AS n, greatest(1, ceil(log2(count(*))))::BIGINT AS powers FROM customer GROUP BY c_nationkey",
)
def fn_powers_of_two(t):
    counted = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("c_nationkey", "n", scalar.powers_of_two_of("n").alias("powers"))


@query(
    "fn_regexp",
    """
SELECT doc_id, nullif(regexp_extract(text, '([A-Z][a-z]+)\\.', 1), '') AS word,
       regexp_matches(text, '[0-9]{3}') AS has_number
FROM documents
""",
)
def fn_regexp(t):
    return t.documents.select(
        "doc_id",
        scalar.regexp_extract("text", r"([A-Z][a-z]+)\.").alias("word"),
        scalar.regexp_contains("text", "[0-9]{3}").alias("has_number"),
    )


@query(
    "fn_json_value",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS missing FROM events",
)
def fn_json_value(t):
    return t.events.select(
        "event_id",
        scalar.json_value("props", "$.k").alias("k"),
        scalar.json_value("props", "$.none").alias("missing"),
    )


@query(
    "fn_to_json",
    "SELECT event_id, '{\"id\":' || user_id || ',\"kind\":\"' || event_type || '\"}' AS doc, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
)
def fn_to_json(t):
    doc = F.to_json(F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")))
    parsed = F.variant_get(scalar.json_parse("props"), "$.k", "bigint")
    return t.events.select("event_id", doc.alias("doc"), parsed.alias("k"))


# user-defined functions


@query("udf_sql", "SELECT p_partkey, p_retailprice * 2 AS xl_price, 200.0::DOUBLE AS default_price FROM part")
def udf_sql(t):
    udf.create_sql_function(t.spark, "price_for_xlarge", {"price": ("double", 100)}, "double", "price * 2")
    return t.part.select(
        "p_partkey",
        F.expr("price_for_xlarge(p_retailprice)").alias("xl_price"),
        F.expr("price_for_xlarge()").alias("default_price"),
    )


@query(
    "udf_temp",
    "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'fine' END AS standing FROM supplier",
)
def udf_temp(t):
    udf.create_sql_function(
        t.spark, "standing_of", {"balance": "double"}, "string", "CASE WHEN balance < 0 THEN 'debt' ELSE 'fine' END"
    )
    return t.supplier.select("s_suppkey", F.expr("standing_of(s_acctbal)").alias("standing"))


@query("udf_python", "SELECT o_orderkey, sqrt(o_totalprice) AS root FROM orders")
def udf_python(t):
    # defined here, so it travels by value and workers need no copy of this package
    def root(x: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series(np.sqrt(x.to_numpy()))

    return t.orders.select("o_orderkey", udf.python_function(root, "double")("o_totalprice").alias("root"))


@query(
    "udaf_sum_positive",
    """
SELECT c_nationkey, coalesce(sum(c_acctbal::DECIMAL(18,2)) FILTER (c_acctbal > 0), 0)::DOUBLE AS owed FROM customer GROUP BY ALL
""",
)
def udaf_sum_positive(t):
    owed = sum_positive(F.col("c_acctbal").cast("decimal(18,2)"))
    return t.customer.groupBy("c_nationkey").agg(owed.cast("double").alias("owed"))


@query("udf_mask_pii", "SELECT doc_id, md5(left(text, 2) || repeat('*', greatest(length(text) - 2, 0))) AS masked FROM documents")
def udf_mask_pii(t):
    return t.documents.select("doc_id", F.md5(udf.mask_pii("text")).alias("masked"))
