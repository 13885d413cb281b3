"""Materialized aggregates that a change feed keeps up to date."""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators.aggregates import SIGN, STALE, Measure, group_state, measured, signed, take_in
from tidemark.operators.buckets import KeyBuckets
from tidemark.operators.changes import CHANGE_TIME, between
from tidemark.operators.merge import col
from tidemark.operators.partition import literal
from tidemark.plans.incremental import read_buckets
from tidemark.session import stage, staging
from tidemark.sources import tables

UNTIL = "tidemark.maintained_until"
APPLIED = "__applied"


@dataclasses.dataclass(frozen=True)
class MaintainedView:
    """Aggregates of a stored table by group, kept in hash buckets of the group.

    A refresh reads the feed since the last one, and of the view the buckets of the groups in it; files of other
    buckets stay. The source is read only for groups that ``take_in`` calls stale, and only in their buckets
    if it is laid out by hash buckets of group columns. Each group notes up to when the feed is in it, so a
    refresh that failed halfway is simply run again: no change is taken in twice. Change rows that arrive
    with a time before the last refresh are not seen; give the feed by its time of arrival.
    """

    name: str
    source: str
    group_by: Sequence[str]
    measures: Mapping[str, Measure]
    buckets: int = 16

    def __post_init__(self):
        if not self.group_by or not self.measures:
            raise ConfigError("a maintained view needs groups and measures")

    @property
    def layout(self) -> KeyBuckets:
        return KeyBuckets(tuple(self.group_by), self.buckets)

    def _key(self) -> Column:
        # structs of equal fields are equal, NULLs included
        return F.struct(*[col(g) for g in self.group_by])

    def create(self, spark: SparkSession, as_of: datetime.datetime) -> None:
        """Compute all groups of the source, which holds the changes before ``as_of``."""
        rows = tables.read_table(spark, self.source).withColumn(SIGN, F.lit(1))
        state = group_state(rows, self.group_by, self.measures)
        tables.create_table_as(state.withColumn(APPLIED, literal(as_of).cast("timestamp")), self.name, buckets=self.layout)
        self._reached(spark, as_of)

    def read(self, spark: SparkSession) -> DataFrame:
        schema = spark.table(self.source).schema
        return measured(tables.read_table(spark, self.name), self.group_by, self.measures, schema)

    def reached(self, spark: SparkSession) -> datetime.datetime:
        """The time up to which the feed has been taken in."""
        text = tables._property(spark, self.name, UNTIL)
        if text is None:
            raise ConfigError(f"{self.name} is not a maintained view")
        return datetime.datetime.fromisoformat(text)

    def _reached(self, spark: SparkSession, until: datetime.datetime) -> None:
        spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{UNTIL}' = '{until.isoformat()}')")

    def _again(self, spark: SparkSession, stale: DataFrame) -> DataFrame:
        """State of the ``stale`` groups from the rows of the source."""
        layout = tables.key_buckets(spark, self.source)
        if layout is not None and layout.covers(list(self.group_by)):
            rows, _ = read_buckets(spark, self.source, stale.select(layout.id_expr(stale.schema).alias("id")))
        else:
            rows = tables.read_table(spark, self.source)
        wanted = stale.select(self._key().alias("__key"))
        rows = rows.withColumn("__key", self._key()).join(wanted, "__key", "left_semi").withColumn(SIGN, F.lit(1))
        return group_state(rows, self.group_by, self.measures)

    def refresh(self, spark: SparkSession, feed: DataFrame, until: datetime.datetime) -> bool:
        """Take in the changes before ``until`` that the view has not; returns whether there were any."""
        since = self.reached(spark)
        if until < since:
            raise ConfigError(f"{self.name} has taken in changes up to {since} already")
        schema = spark.table(self.source).schema
        used = list(dict.fromkeys([*self.group_by, *[m.column for m in self.measures.values() if m.column]]))
        with staging(spark):
            rows = signed(between(feed, since, until)).select(*[col(c) for c in used], SIGN, CHANGE_TIME)
            rows = stage(rows, "feed")
            if rows.isEmpty():
                self._reached(spark, until)
                return False
            state, touched = read_buckets(spark, self.name, rows.select(self.layout.id_expr(rows.schema).alias("id")))
            # groups that a failed run has written are ahead of the view
            ahead = state.where(F.col(APPLIED) > literal(since).cast("timestamp")).select(self._key().alias("__at"), F.col(APPLIED).alias("__to"))
            keyed = rows.withColumn("__key", self._key())
            fresh = keyed.join(ahead, (F.col("__key") == F.col("__at")) & (F.col(CHANGE_TIME) < F.col("__to")), "left_anti")
            delta = group_state(fresh, self.group_by, self.measures, removed=True)
            folded = take_in(state, delta, self.group_by, self.measures, schema)
            marks = state.select(self._key().alias("__at"), F.col(APPLIED).alias("__to"))
            folded = stage(folded.withColumn("__key", self._key()).join(marks, F.col("__key") == F.col("__at"), "left").drop("__at"), "folded")
            stale = stage(folded.where(STALE).select(*[col(g) for g in self.group_by]), "stale")
            result = folded
            if not stale.isEmpty():
                again = self._again(spark, stale)
                new = again.select(self._key().alias("__of"), *[F.col(c).alias(f"new {c}") for c in self._reread(schema)])
                result = folded.join(new, F.col("__key") == F.col("__of"), "left").withColumns(
                    {c: F.when(F.col(STALE), F.col(f"`new {c}`")).otherwise(F.col(c)) for c in self._reread(schema)}
                )
            now = literal(until).cast("timestamp")
            result = result.withColumn(APPLIED, F.when(F.col("__touched"), now).otherwise(F.col("__to")))
            # an empty group stays until no earlier change can come again
            kept = result.where((F.col("__rows") > 0) | (F.col(APPLIED) > literal(since).cast("timestamp")))
            tables.replace_partitions(kept.select(*[col(c) for c in state.columns]), self.name, touched)
        self._reached(spark, until)
        return True

    def _reread(self, schema) -> list[str]:
        """State columns that a stale group takes from its rows."""
        out = []
        for name, m in self.measures.items():
            if m.extreme:
                out.append(f"{name}__end")
            elif not m.exact(schema):
                out.append(f"{name}__sum")
        return out
