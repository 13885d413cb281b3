"""Contiguous shards of equal bytes, cut on a global prefix sum made from partition totals.

Rows are range-partitioned by their key and sorted. Each partition gives one total of bytes and rows;
the running sum over these few totals is added to the running sum inside each partition, which is a
row's place in the whole. Shard ``k`` takes the rows whose middle byte lies in the k-th of equal parts
of all bytes, so no shard is off by more than one row. Ties in the key are told apart by a row number,
so no group of equal keys has to meet in one task.

Contract. The size of a null text is 0 bytes; every size has 1 added. Null keys come first. Repeated
rows are placed next to each other. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import quoted
from tidemark.session import stage

#: Rows of one range partition, about.
PART_ROWS = 100_000


def shards(docs: DataFrame, count: int = 8, key: str = "doc_id", text: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``place`` (of the row in the whole, from 0)."""
    spark = docs.sparkSession
    raw = F.coalesce(F.encode(quoted(text), "UTF-8"), F.lit(b""))
    sized = stage(
        docs.select(
            quoted(key).alias("key"),
            (F.octet_length(raw) + 1).cast("bigint").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )
    parts = max(1, math.ceil(sized.count() / part_rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = stage(
        sized.repartitionByRange(parts, F.col("key").asc_nulls_first(), "row").withColumn("part", F.spark_partition_id()),
        "placed",
    )
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(F.col("key").asc_nulls_first(), "row")
    running = placed.select(
        "*",
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("bytes_inside"),
        (F.row_number().over(inside) - 1).cast("bigint").alias("rows_inside"),
    )
    middle = 2 * (F.col("bytes_before") + F.col("bytes_inside")) + F.col("size")
    shard = F.floor(middle.cast("decimal(38,0)") * count / (2 * F.col("all_bytes")).cast("decimal(38,0)"))
    cut = running.join(starts, "part").select(
        "key", "size", "text_crc32",
        F.least(shard, F.lit(count - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("rows_inside")).alias("place"),
    )
    # one row for each shard
    first = cut.groupBy("shard").agg(F.min("place").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(
        F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"), "place"
    )
