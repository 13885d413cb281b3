"""Snapshots kept in a table."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.schema import conform, schema_diff
from tidemark.operators.snapshot import SnapshotColumns, snapshot
from tidemark.session import staged
from tidemark.sources import tables

OPEN = "open"


def snapshot_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    unique_key: str | Sequence[str],
    *,
    now: datetime.datetime,
    columns: SnapshotColumns = SnapshotColumns(),
    **options,
) -> str:
    """Run a snapshot into a table; options as for ``snapshot``.

    Open versions form one partition, the versions closed by a run another. A run reads
    and rewrites the open ones only, so its cost does not grow with the history, and one
    write job replaces the open ones and adds the closed ones. A run can be repeated: what it has
    stored already is no change the second time.
    """
    options = {**options, "now": now, "columns": columns}
    # a name of its own for each commit: two runs may share ``now``, and neither may replace the other's rows
    run = f"closed {now.isoformat(sep=' ')} {uuid.uuid4().hex[:12]}"

    def placed(df: DataFrame) -> DataFrame:
        is_open = F.col(columns.valid_to).isNull()
        return df.withColumn(tables.BUCKET, F.when(is_open, OPEN).otherwise(run))

    if not tables.is_table(spark, name):
        tables.create_table_as(placed(snapshot(None, source, unique_key, **options)), name)
        return "created"
    with staged(source, "snapshot") as rows:
        result = snapshot(_open_versions(spark, name), rows, unique_key, **options)
        if grow(spark, name, result.schema):
            result = snapshot(_open_versions(spark, name), rows, unique_key, **options)
        tables.replace_partitions(placed(result), name, [OPEN])
    return "updated"


def _open_versions(spark: SparkSession, name: str) -> DataFrame:
    return tables.read_table(spark, name, [OPEN])


def grow(spark: SparkSession, name: str, goal) -> bool:
    """Give a stored snapshot the columns of its next state; returns whether it changed."""
    have = tables.read_table(spark, name).schema
    diff = schema_diff(goal, have)
    if not diff:
        return False
    if not diff.new_types:
        tables.add_table_columns(spark, name, [f for f in goal.fields if f.name in diff.source_not_in_target])
        return True
    stored = spark.table(name)
    wider = type(goal)([*goal.fields, stored.schema[tables.BUCKET]])
    tables.create_table_as(conform(stored, wider), name)
    return True
