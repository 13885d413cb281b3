"""Catalog tables with partition layout: create, replace, append, copy, re-layout.

A partitioned table carries one extra physical column, the text id of its partition, so
that partition lists from change tracking prune folders directly.
"""

from __future__ import annotations

import dataclasses
import datetime
import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.functions.scalar import type_text
from tidemark.operators.buckets import KeyBuckets
from tidemark.operators.merge import col, quoted
from tidemark.operators.partition import PartitionSpec
from tidemark.session import setting

BUCKET = "__bucket"
LAYOUT = "tidemark.layout"
REFRESHED = "tidemark.refreshed_at"
MAX_CLUSTER_COLUMNS = 4
FAST_STATS = "spark.sql.hive.gatherFastStats"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def is_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType in ("MANAGED", "EXTERNAL")


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and not is_table(spark, name)


def read_table(spark: SparkSession, name: str, partition_ids: Sequence[str] | None = None) -> DataFrame:
    """A table's rows without its physical partition column.

    The table is refreshed first, as another session (each streaming sink runs in its own)
    may have replaced its files.
    """
    spark.catalog.refreshTable(name)
    df = spark.table(name)
    if BUCKET not in df.columns:
        return df
    if partition_ids is not None:
        df = df.where(F.col(BUCKET).isin(list(partition_ids)))
    return df.drop(BUCKET)


def _layout_text(partition: PartitionSpec | None, cluster_by: Sequence[str], buckets: KeyBuckets | None) -> str:
    layout = {"partition": dataclasses.asdict(partition) if partition else None, "cluster_by": list(cluster_by)}
    if buckets is not None:
        layout["buckets"] = dataclasses.asdict(buckets)
    return json.dumps(layout)


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        if row["key"] == key:
            return row["value"]
    return None


def table_layout(spark: SparkSession, name: str) -> tuple[PartitionSpec | None, list[str]]:
    """Partition spec and cluster columns a table was written with."""
    text = _property(spark, name, LAYOUT)
    if text is None:
        return None, []
    raw = json.loads(text)
    return PartitionSpec.parse(raw["partition"]), raw["cluster_by"]


def key_buckets(spark: SparkSession, name: str) -> KeyBuckets | None:
    """The hash buckets a table is laid out by, if it is."""
    raw = json.loads(_property(spark, name, LAYOUT) or "{}").get("buckets")
    return None if raw is None else KeyBuckets(tuple(raw["keys"]), raw["count"])


def _arrange(
    df: DataFrame, partition: PartitionSpec | None, cluster_by: Sequence[str], buckets: KeyBuckets | None = None
) -> DataFrame:
    """Bring rows of a partition together, then sort them by the cluster columns.

    ``rebalance`` lets AQE split a partition that holds much of the data over several
    tasks and fold small ones, which ``repartition`` by the same column cannot do.
    """
    if len(cluster_by) > MAX_CLUSTER_COLUMNS:
        raise ConfigError(f"at most {MAX_CLUSTER_COLUMNS} cluster columns are allowed")
    order = list(cluster_by)
    if partition is not None:
        df = df.withColumn(BUCKET, partition.id_expr())
    elif buckets is not None:
        df = df.withColumn(BUCKET, buckets.id_expr(df.schema))
    if BUCKET in df.columns:
        df = df.hint("rebalance", BUCKET)
        order = [BUCKET, *order]
    elif cluster_by:
        df = df.hint("rebalance")
    return df.sortWithinPartitions(*order) if order else df


def create_table_as(
    df: DataFrame,
    name: str,
    partition: PartitionSpec | None = None,
    cluster_by: Sequence[str] = (),
    buckets: KeyBuckets | None = None,
) -> None:
    """Create or replace a table from a query.

    The rows are written under a new name which then takes the old table's place: the
    query may read the table it replaces, and a failed job leaves the old table as it is.
    Rows may also bring their own partition id, in a column named ``__bucket``. ``buckets`` lays the table
    out by the hash of a key instead of a partition.
    """
    spark = df.sparkSession
    if partition is not None and buckets is not None:
        raise ConfigError("a table has a partition or hash buckets, not both")
    if is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    exists = is_table(spark, name)
    goal = f"{name}__{uuid.uuid4().hex[:12]}" if exists else name
    rows = _arrange(df, partition, cluster_by, buckets)
    writer = rows.write.format("parquet")
    if BUCKET in rows.columns:
        writer = writer.partitionBy(BUCKET)
    with setting(spark, FAST_STATS, "false"):
        writer.saveAsTable(goal)
    spark.sql(f"ALTER TABLE {goal} SET TBLPROPERTIES ('{LAYOUT}' = '{_layout_text(partition, cluster_by, buckets)}')")
    if exists:
        spark.sql(f"DROP TABLE {name}")
        rename_table(spark, goal, name)


def create_view_as(df: DataFrame, name: str, *, full_refresh: bool = False) -> None:
    """A named query that is never stored; replacing a table needs ``full_refresh``."""
    spark = df.sparkSession
    if is_table(spark, name):
        if not full_refresh:
            raise ConfigError(f"{name} is a table; replacing it by a view needs a full refresh")
        spark.sql(f"DROP TABLE {name}")
    df.createOrReplaceTempView(name.split(".")[-1])


def _physical(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    partition, cluster_by = table_layout(spark, name)
    df = _arrange(df, partition, cluster_by, key_buckets(spark, name))
    return df.select([col(c) for c in spark.table(name).columns])


def append_rows(df: DataFrame, name: str) -> None:
    rows = _physical(df.sparkSession, name, df)
    rows.write.mode("append").insertInto(name)


def replace_partitions(
    df: DataFrame, name: str, emptied: Iterable[str | None] | DataFrame = (), *, null_too: bool = False
) -> None:
    """Replace every partition that occurs in ``df`` by its rows there.

    Partitions in ``emptied`` (ids, or a one-column DataFrame of ids of the catalog) that turn out to
    have no row are dropped. Which partitions
    were written is observed by the write itself. Rows with a NULL partition are not
    accepted, as they would replace all earlier ones; with ``null_too`` that is what is wanted, and NULL
    is an id like any other.
    """
    spark = df.sparkSession
    rows = _physical(spark, name, df)
    if BUCKET not in rows.columns:
        raise ConfigError(f"{name} is not partitioned")
    if isinstance(emptied, DataFrame):
        emptied = [r[0] for r in emptied.collect()]
    emptied = set(emptied)
    if None in emptied and not null_too:
        raise ConfigError("the partition of rows without a date cannot be replaced")
    written = Observation()
    if not null_too:
        rows = rows.where(F.assert_true(F.col(BUCKET).isNotNull(), "a row has no partition").isNull())
    watched = rows.observe(
        written, F.collect_set(BUCKET).alias("ids"), F.count_if(F.col(BUCKET).isNull()).alias("nulls")
    )
    with setting(spark, OVERWRITE_MODE, "dynamic"):
        watched.write.mode("overwrite").insertInto(name)
    # an empty write reports no list
    seen = set(written.get.get("ids") or [])
    if written.get.get("nulls"):
        seen.add(None)
    drop_partitions(spark, name, emptied - seen)


def drop_partitions(spark: SparkSession, name: str, ids: Iterable[str | None]) -> None:
    """Drop partitions by id; ``None`` is the partition of rows without one."""
    values = sorted("null" if i is None else f"'{i}'" for i in ids)
    for start in range(0, len(values), 500):
        specs = ", ".join(f"PARTITION ({BUCKET} = {v})" for v in values[start : start + 500])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Partition ids of a table, read from the catalog alone; NULL for rows without one."""
    prefix = f"{BUCKET}="
    ident = F.url_decode(F.expr(f"substr(partition, {len(prefix) + 1})"))
    return spark.sql(f"SHOW PARTITIONS {name}").select(
        F.when(ident != "__HIVE_DEFAULT_PARTITION__", ident).alias("partition_id")
    )


def partition_rows(df: DataFrame, partition: PartitionSpec) -> DataFrame:
    """Partition ids of any DataFrame with their number of rows."""
    return df.groupBy(partition.id_expr().alias("partition_id")).agg(F.count(F.lit(1)).alias("row_count"))


def copy_table(sources: DataFrame | Sequence[DataFrame], name: str, mode: str = "table") -> None:
    """Copy one or more relations into a table: ``incremental`` appends, ``table`` replaces."""
    if mode not in ("incremental", "table"):
        raise ConfigError(f"copy mode must be incremental or table, not {mode!r}")
    parts = [sources] if isinstance(sources, DataFrame) else list(sources)
    if not parts:
        raise ConfigError("nothing to copy")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    spark = stacked.sparkSession
    if mode == "incremental" and is_table(spark, name):
        append_rows(stacked, name)
        return
    exists = is_table(spark, name)
    partition, cluster_by = table_layout(spark, name) if exists else (None, [])
    create_table_as(stacked, name, partition, cluster_by, key_buckets(spark, name) if exists else None)


def clone(spark: SparkSession, source: str, name: str) -> None:
    """A full copy of a table in its layout, or the same view under another name."""
    if not is_table(spark, source):
        create_view_as(spark.table(source), name, full_refresh=True)
        return
    partition, cluster_by = table_layout(spark, source)
    create_table_as(read_table(spark, source), name, partition, cluster_by, key_buckets(spark, source))


def same_layout(
    spark: SparkSession, name: str, partition: PartitionSpec | None, cluster_by: Sequence[str], buckets: KeyBuckets | None = None
) -> bool:
    have, clustered = table_layout(spark, name)
    if (have is None) != (partition is None) or key_buckets(spark, name) != buckets:
        return False
    return list(clustered) == list(cluster_by) and (partition is None or partition.same_layout(have))


def relayout(
    spark: SparkSession,
    name: str,
    partition: PartitionSpec | None,
    cluster_by: Sequence[str] = (),
    buckets: KeyBuckets | None = None,
) -> bool:
    """Rewrite a table whose layout differs from the wanted one; returns whether it did."""
    if same_layout(spark, name, partition, cluster_by, buckets):
        return False
    create_table_as(read_table(spark, name), name, partition, cluster_by, buckets)
    return True


def rename_table(spark: SparkSession, name: str, new_name: str) -> None:
    if not is_table(spark, name):
        raise ConfigError(f"{name} is not a table; views cannot be renamed")
    spark.sql(f"ALTER TABLE {name} RENAME TO {new_name}")
    _follow_partitions(spark, new_name)


def _location(spark: SparkSession, statement: str) -> str:
    for row in spark.sql(statement).collect():
        if row["col_name"] == "Location":
            return row["data_type"]
    raise ConfigError(f"no location: {statement}")


def location(spark: SparkSession, name: str) -> str:
    """The folder of a table."""
    return _location(spark, f"DESCRIBE EXTENDED {name}")


def _follow_partitions(spark: SparkSession, name: str) -> None:
    """Let a renamed table find its partitions where they now are.

    Spark's in-memory catalog moves the folder of a renamed table but keeps the old places
    of its partitions. Such entries, whose folders are gone, are dropped and found anew;
    a metastore that moved them itself is left alone.
    """
    if BUCKET not in spark.table(name).columns:
        return
    first = list_partitions(spark, name).where("partition_id is not null").first()
    if first is None:
        return
    place = _location(spark, f"DESCRIBE EXTENDED {name} PARTITION ({BUCKET} = '{first[0]}')")
    if place.startswith(_location(spark, f"DESCRIBE EXTENDED {name}").rstrip("/") + "/"):
        return
    drop_partitions(spark, name, [r[0] for r in list_partitions(spark, name).collect()])
    with setting(spark, FAST_STATS, "false"):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def add_table_columns(spark: SparkSession, name: str, fields: Sequence[T.StructField]) -> None:
    """Add top-level columns without touching the data: old files read as NULL."""
    if fields:
        ddl = ", ".join(f"{quoted(f.name)} {type_text(f.dataType)}" for f in fields)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl})")


def rewrite_table(spark: SparkSession, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a table by a function of itself, in the same layout."""
    partition, cluster_by = table_layout(spark, name)
    create_table_as(change(read_table(spark, name)), name, partition, cluster_by, key_buckets(spark, name))


def load_seed(df: DataFrame, name: str) -> None:
    """Store loaded rows, replacing earlier ones; a load without rows still makes the table."""
    create_table_as(df, name)


def python_model(
    spark: SparkSession,
    model: Callable,
    name: str,
    partition: PartitionSpec | None = None,
    cluster_by: Sequence[str] = (),
) -> None:
    """Store the result of a Python model that returns a Spark, pandas-on-Spark or pandas frame."""
    import pandas as pd

    made = model(spark)
    if isinstance(made, DataFrame):
        df = made
    elif isinstance(made, pd.DataFrame):
        df = spark.createDataFrame(made)
    elif type(made).__module__.startswith("pyspark.pandas") and hasattr(made, "to_spark"):
        df = made.to_spark()
    else:
        raise ConfigError(f"a model must return a DataFrame, not {type(made).__name__}")
    create_table_as(df, name, partition, cluster_by)


@dataclasses.dataclass(frozen=True)
class MaterializedView:
    """A stored query that is recomputed on demand or once it is older than its interval."""

    name: str
    query: Callable[[SparkSession], DataFrame]
    partition: PartitionSpec | None = None
    cluster_by: tuple[str, ...] = ()
    refresh_interval_minutes: float = 30

    def refresh(self, spark: SparkSession, now: datetime.datetime, *, force: bool = False) -> bool:
        """Recompute if due, forced, missing or in another layout; returns whether it did."""
        if is_table(spark, self.name) and not force:
            last = _property(spark, self.name, REFRESHED)
            age = None if last is None else now - datetime.datetime.fromisoformat(last)
            due = age is None or age >= datetime.timedelta(minutes=self.refresh_interval_minutes)
            if not due and same_layout(spark, self.name, self.partition, self.cluster_by):
                return False
        create_table_as(self.query(spark), self.name, self.partition, self.cluster_by)
        spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{REFRESHED}' = '{now.isoformat()}')")
        return True


def store_failures(failures: DataFrame, name: str) -> int:
    """Save the failing rows of a test as a table and return their number."""
    create_table_as(failures, name)
    return failures.sparkSession.table(name).count()


