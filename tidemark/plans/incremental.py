"""Incremental builds: first run, later runs and full refresh of a stored query."""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.operators.buckets import MAX_BUCKETS, NO_KEY, KeyBuckets
from tidemark.operators.fanout import overwrite_params
from tidemark.operators.merge import _align, all_of, col, insert_rows, key_list, merge
from tidemark.operators.overwrite import delete_where, insert_overwrite, partition_values
from tidemark.operators.partition import PartitionSpec
from tidemark.operators.quality import enforce_contract
from tidemark.operators.schema import conform, evolved_schema, schema_diff
from tidemark.operators.sizing import key_set, split_by_keys
from tidemark.session import staged, staging
from tidemark.sources import tables
from tidemark.sources.loads import event_time_filter

STRATEGIES = ("merge", "insert_overwrite", "microbatch")
BATCH_SIZES = ("hour", "day", "month", "year")


@dataclasses.dataclass(frozen=True)
class BuildConfig:
    """Options of an incremental build."""

    strategy: str = "merge"
    unique_key: str | Sequence[str] | None = None
    partition: PartitionSpec | None = None
    cluster_by: tuple[str, ...] = ()
    partitions: Sequence[Any] | None = None
    on_schema_change: str = "ignore"
    predicates: tuple[str, ...] = ()
    update_columns: Sequence[str] | None = None
    exclude_columns: Sequence[str] | None = None
    skip_unchanged: bool = False
    stable_columns: Sequence[str] | None = None
    unstable_columns: Sequence[str] | None = None
    null_safe: bool = False
    partition_scope: str = "source_dates"
    event_time: str | None = None
    batch_size: str | None = None
    begin: datetime.datetime | None = None
    lookback: int = 1
    contract: T.StructType | str | None = None
    not_null: tuple[str, ...] = ()
    key_buckets: int = 0

    @property
    def buckets(self) -> KeyBuckets | None:
        """Layout by the hash of the key, for a merge into a table without a partition."""
        return KeyBuckets(tuple(key_list(self.unique_key)), self.key_buckets) if self.key_buckets else None

    def check(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ConfigError(f"unknown incremental strategy {self.strategy!r}")
        if self.strategy != "merge" and self.skip_unchanged:
            raise ConfigError("skip_unchanged only applies to the merge strategy")
        if self.strategy == "insert_overwrite" and self.partition is None:
            raise ConfigError("insert_overwrite needs a partition")
        if self.strategy == "merge" and self.partition is not None and self.partition.copy_partitions:
            raise ConfigError("merge does not copy partitions")
        if self.key_buckets and (self.strategy != "merge" or self.partition is not None or not key_list(self.unique_key)):
            raise ConfigError("key_buckets needs the merge strategy with a unique_key and no partition")
        if self.strategy == "microbatch":
            check_microbatch(self.partition, self.batch_size)
            if not self.event_time or self.begin is None:
                raise ConfigError("microbatch needs event_time and begin")
            if self.lookback < 0:
                raise ConfigError("lookback must not be negative")

    def merge_options(self) -> dict:
        return {
            "update_columns": self.update_columns,
            "exclude_columns": self.exclude_columns,
            "skip_unchanged": self.skip_unchanged,
            "stable_columns": self.stable_columns,
            "unstable_columns": self.unstable_columns,
            "predicates": self.predicates,
            "null_safe": self.null_safe,
        }


    def shape(self, rows: DataFrame) -> DataFrame:
        """A model's rows as they are stored: under contract, with the hidden ingestion time."""
        if self.contract is not None:
            rows = enforce_contract(rows, self.contract, self.not_null)
        if self.partition is not None and self.partition.ingestion_time:
            rows = self.partition.with_ingestion_time(rows)
        return rows


# ---- writing merge and overwrite results: only touched partitions are rewritten


def merge_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    unique_key: str | Sequence[str] | None,
    *,
    partition_scope: str = "source_dates",
    dest_columns: Sequence[str] | None = None,
    is_staged: bool = False,
    **options,
) -> None:
    """Merge into a stored table.

    Without a key the rows are appended. In a time-partitioned table under
    ``source_dates`` only the partitions of the source's days are read and rewritten; a merge over
    a whole partitioned table rewrites the partitions of the matched keys and of the source, that of
    rows without a date included. A table in hash buckets of the key (or of some of its columns) reads and
    rewrites the buckets of the source's keys. Only a table without either is written anew
    beside the old one and swapped in. The source is
    stored first, as the merge reads it several times; ``is_staged`` says it already is.
    """
    partition, cluster_by = tables.table_layout(spark, name)
    buckets = tables.key_buckets(spark, name)
    target = tables.read_table(spark, name)
    dest = list(dest_columns or target.columns)
    if not key_list(unique_key):
        tables.append_rows(insert_rows(target, _align(source, target, dest), dest), name)
        return
    if not is_staged:
        with staged(source, "merge") as rows:
            merge_table(
                spark,
                name,
                rows,
                unique_key,
                partition_scope=partition_scope,
                dest_columns=dest_columns,
                is_staged=True,
                **options,
            )
        return
    options = {**options, "dest_columns": dest_columns}
    if partition is not None and partition.is_time and partition_scope == "source_dates":
        ids = _align(source, target, dest).select(partition.id_expr().alias("id"))
        _merge_partitions(spark, name, source, unique_key, partition, ids, options)
        return
    if buckets is not None and buckets.covers(unique_key):
        with staging(spark):
            _merge_buckets(spark, name, source, unique_key, buckets, dest, options)
        return
    if partition is not None:
        null_safe = options.get("null_safe") and isinstance(unique_key, str)
        ids = _matched_ids(spark, name, _align(source, target, dest), key_list(unique_key), partition, null_safe)
        with staged(ids, "ids") as fixed:
            _merge_partitions(spark, name, source, unique_key, partition, fixed, {**options, "partition_scope": "all"})
        return
    result = merge(
        target, source, unique_key, partition=partition, partition_scope=partition_scope, **options
    )
    tables.create_table_as(result, name, partition, cluster_by, buckets)


def _merge_buckets(spark, name, source, unique_key, buckets, dest, options) -> None:
    """Merge into the buckets of the source's keys; the files of all others stay as they are."""
    target = tables.read_table(spark, name)
    rows = _align(source, target, dest)
    ident = buckets.id_expr(rows.schema)
    # a key with a NULL matches nothing, so its row is only added
    alone = None
    if not (options.get("null_safe") and isinstance(unique_key, str)):
        alone, rows = rows.where(ident == NO_KEY), rows.where(ident != NO_KEY)
    scope, touched = read_buckets(spark, name, rows.select(ident.alias("id")))
    result = merge(scope, rows, unique_key, **options)
    tables.replace_partitions(result, name, touched)
    if alone is not None and not alone.isEmpty():
        tables.append_rows(insert_rows(target, alone, dest), name)


def read_buckets(spark: SparkSession, name: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a stored table in the given buckets, and which of these buckets it has.

    The list of buckets is a filter on the partition column, so no other folder is read; ``MAX_BUCKETS``
    bounds it.
    """
    wanted = [r[0] for r in ids.distinct().limit(MAX_BUCKETS + 1).collect()]
    spark.catalog.refreshTable(name)
    existing = tables.list_partitions(spark, name)
    return (
        spark.table(name).where(F.col(tables.BUCKET).isin(wanted)).drop(tables.BUCKET),
        existing.where(F.col("partition_id").isin(wanted)),
    )


def _matched_ids(spark, name, source, keys, partition, null_safe) -> DataFrame:
    """Partitions that a merge over the whole table touches: those of the source, and those of matched keys."""
    stored = spark.table(name).select(*[col(k) for k in keys], F.col(tables.BUCKET).alias("__id")).alias("dest")
    wanted = source.select(*[col(k) for k in keys]).alias("source")
    pairs = [(col(k, "dest"), col(k, "source")) for k in keys]
    on = all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    matched = stored.join(wanted, on, "left_semi").select("__id")
    return matched.union(source.select(partition.id_expr())).distinct().toDF("id")


def _merge_partitions(spark, name, source, unique_key, partition, ids, options) -> None:
    with staging(spark):
        _merge_touched(spark, name, source, unique_key, partition, ids, options)


def _merge_touched(spark, name, source, unique_key, partition, ids, options) -> None:
    """Merge into the partitions with the given ids, however many; all others stay as they are."""
    day = lambda ident: F.substring(ident, 1, 10)
    hourly = partition.is_time and partition.granularity == "hour" and "partition_scope" not in options
    # an hourly table is matched by day
    touched = key_set(ids.select(day(F.col("id")).alias("id") if hourly else "id"))
    column = F.col(tables.BUCKET)
    spark.catalog.refreshTable(name)
    scope, _ = split_by_keys(spark.table(name), day(column) if hourly else column, touched)
    no_date = not ids.where("id is null").isEmpty()
    everywhere = no_date and options.get("partition_scope") == "all"
    if everywhere:
        scope = scope.unionByName(spark.table(name).where(column.isNull()))
    result = merge(scope.drop(tables.BUCKET), source, unique_key, partition=partition, **options)
    stored = tables.list_partitions(spark, name)
    existing = stored.where("partition_id is not null")
    ident = F.col("partition_id")
    rewritten, _ = split_by_keys(existing, day(ident) if hourly else ident, touched)
    if everywhere:
        # rows without a date are one partition more
        rewritten = rewritten.union(stored.where("partition_id is null"))
        tables.replace_partitions(result, name, rewritten, null_too=True)
        return
    if not no_date:
        tables.replace_partitions(result, name, rewritten)
        return
    # rows without a partition are appended, never replaced; the result is fixed first
    no_bucket = partition.id_expr().isNull()
    with staged(result, "merged") as fixed:
        tables.replace_partitions(fixed.where(~no_bucket), name, rewritten)
        tables.append_rows(fixed.where(no_bucket), name)


def overwrite_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    *,
    partitions: Sequence[Any] | None = None,
    copy: bool | None = None,
    dest_columns: Sequence[str] | None = None,
    is_staged: bool = False,
) -> None:
    """Replace partitions of a stored table by the source's rows; others are not read.

    Semantics as in ``insert_overwrite``. The source is stored first, since it is read
    for its partitions and then written.
    """
    partition, _ = tables.table_layout(spark, name)
    if partition is None:
        raise ConfigError(f"{name} is not partitioned")
    target = tables.read_table(spark, name)
    copy = partition.copy_partitions if copy is None else copy
    dest = list(dest_columns or target.columns)
    rows = insert_rows(target, _align(source, target, dest), dest)
    if is_staged:
        _overwrite(spark, name, rows, partition, partitions, copy)
    else:
        with staged(rows, "overwrite") as fixed:
            _overwrite(spark, name, fixed, partition, partitions, copy)


def _overwrite(spark, name, rows, partition, partitions, copy) -> None:
    ident = partition.id_expr()
    if partitions:
        values = partition_values(rows, partition, partitions, truncate=copy)
        wanted = [r[0] for r in values.select(partition.id_expr(F.col("bucket"))).distinct().collect()]
        inside = F.coalesce(ident.isin(wanted), F.lit(False))
        tables.replace_partitions(rows.where(inside), name, wanted)
        extra = rows.where(~inside)
        if not copy and not extra.isEmpty():
            tables.append_rows(extra, name)
        return
    orphans = rows.where(ident.isNull())
    has_orphans = not orphans.isEmpty()
    if copy and has_orphans:
        raise ConfigError("copy: a source row has no partition")
    tables.replace_partitions(rows.where(ident.isNotNull()), name)
    if has_orphans:
        tables.append_rows(orphans, name)


def overwrite_table_buckets(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    params: DataFrame,
    param: str,
    source_param: str | None = None,
) -> None:
    """Replace the partitions named by a parameter column in a stored table, all in one write."""
    partition, _ = tables.table_layout(spark, name)
    if partition is None or not partition.is_time:
        raise ConfigError("a parameterised overwrite needs a time-partitioned table")
    if source_param is not None:
        source = source.where(
            partition.bucket_expr() == partition.bucket_expr(col(source_param))
        ).drop(source_param)
    ident = partition.id_expr(col(param))
    # a NULL would name the partition of the rows without a date
    if not params.where(ident.isNull()).isEmpty():
        raise ConfigError(f"parameter {param} is NULL")
    with staging(spark):
        _replace_named(spark, name, source, partition, key_set(params.select(ident.alias("id"))))


def _replace_named(spark, name, source, partition, wanted) -> None:
    """Replace the partitions of a key set by the source's rows there; those left without rows go."""
    target = tables.read_table(spark, name)
    rows = insert_rows(target, _align(source, target, target.columns), target.columns)
    inside, _ = split_by_keys(rows, partition.id_expr(), wanted, partition.span(rows))
    existing = tables.list_partitions(spark, name).where("partition_id is not null")
    tables.replace_partitions(inside, name, split_by_keys(existing, F.col("partition_id"), wanted)[0])


def delete_from_table(spark: SparkSession, name: str, predicate: str, partition_ids: Sequence[str] | DataFrame) -> None:
    """Delete the rows of some partitions for which a predicate is true; others are neither read nor written."""
    if not isinstance(partition_ids, DataFrame):
        partition_ids = spark.createDataFrame([(i,) for i in partition_ids], "id string")
    with staging(spark):
        touched = key_set(partition_ids)
        spark.catalog.refreshTable(name)
        scope, _ = split_by_keys(spark.table(name), F.col(tables.BUCKET), touched)
        existing = tables.list_partitions(spark, name).where("partition_id is not null")
        emptied, _ = split_by_keys(existing, F.col("partition_id"), touched)
        tables.replace_partitions(delete_where(scope.drop(tables.BUCKET), predicate), name, emptied)


# ---- schema changes of stored tables


def sync_table_schema(spark: SparkSession, name: str, source: DataFrame, mode: str) -> None:
    """Bring a stored table to the schema the mode asks for.

    Plain new columns are added in the catalog only; any other change rewrites the table.
    """
    target = tables.read_table(spark, name)
    goal = evolved_schema(target.schema, source.schema, mode)
    diff = schema_diff(goal, target.schema)
    if not diff:
        return
    if not diff.target_not_in_source and not diff.new_types:
        tables.add_table_columns(spark, name, [f for f in goal.fields if f.name in diff.source_not_in_target])
        return
    tables.rewrite_table(spark, name, lambda df: conform(df, goal))


# ---- builds

Model = Callable[[SparkSession, "DataFrame | None"], DataFrame]


def build_incremental(
    spark: SparkSession,
    name: str,
    model: Model,
    config: BuildConfig,
    *,
    full_refresh: bool = False,
    now: datetime.datetime | None = None,
    batches: tuple[datetime.datetime, datetime.datetime] | None = None,
) -> str:
    """Build or update a table from a model.

    ``model(spark, target)`` returns the rows; ``target`` is ``None`` when the table is
    built from nothing. A microbatch build runs the batches of ``batches`` (begin, end), else those
    from ``config.lookback`` before the newest stored one up to ``now``. Returns ``created`` or ``updated``.
    """
    config.check()
    if tables.is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    exists = tables.is_table(spark, name)
    if config.strategy == "microbatch":
        return _build_microbatch(spark, name, model, config, exists and not full_refresh, now, batches)
    if not exists or full_refresh:
        tables.create_table_as(config.shape(model(spark, None)), name, config.partition, config.cluster_by, config.buckets)
        return "created"
    # stored before the schema changes, as the model may read the table as it was
    with staged(config.shape(model(spark, tables.read_table(spark, name))), "build") as source:
        dest = None
        if config.on_schema_change != "ignore":
            sync_table_schema(spark, name, source, config.on_schema_change)
            have = {c.lower() for c in source.columns}
            dest = [c for c in tables.read_table(spark, name).columns if c.lower() in have]
        _apply(spark, name, source, config, dest)
    return "updated"


def _apply(spark, name, source, config: BuildConfig, dest) -> None:
    if config.strategy == "merge":
        merge_table(
            spark,
            name,
            source,
            config.unique_key,
            partition_scope=config.partition_scope,
            dest_columns=dest,
            is_staged=True,
            **config.merge_options(),
        )
    else:
        overwrite_table(
            spark, name, source, partitions=config.partitions, dest_columns=dest, is_staged=True
        )


def build_parameterised(
    spark: SparkSession,
    name: str,
    model: Callable[[SparkSession, DataFrame], DataFrame],
    params: DataFrame,
    config: BuildConfig,
    *,
    full_refresh: bool = False,
    order_by: str | None = None,
    source_param: str | None = None,
) -> str:
    """Build a table from a model that is run for many parameter sets at once.

    ``model(spark, params)`` joins its query with the parameters (see ``fan_out``). The
    table is made empty on the first run or a full refresh, so first and later runs take
    the same path: a merge, or an overwrite of the partitions the parameters name.
    """
    config.check()
    if config.strategy not in ("merge", "insert_overwrite"):
        raise ConfigError("a parameterised build merges or overwrites")
    if config.partition is not None and config.partition.ingestion_time:
        raise ConfigError("a parameterised build does not support ingestion-time partitions")
    overwrite = config.strategy == "insert_overwrite"
    if overwrite:
        if config.unique_key:
            raise ConfigError("a parameterised overwrite takes no unique_key")
        if not config.partition.is_time:
            raise ConfigError("a parameterised overwrite needs a time partition")
        if config.partition.copy_partitions:
            raise ConfigError("a parameterised overwrite does not copy partitions")
        params = overwrite_params(params, config.partition, order_by)
    if params.isEmpty():
        raise ConfigError("a parameterised build needs at least one parameter set")
    source = model(spark, params)
    shape = source.drop(source_param) if source_param else source
    if tables.is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    fresh = full_refresh or not tables.is_table(spark, name)
    if fresh:
        tables.create_table_as(shape.limit(0), name, config.partition, config.cluster_by, config.buckets)
    elif config.on_schema_change != "ignore":
        sync_table_schema(spark, name, shape, config.on_schema_change)
        # planned anew, as the model may read the table
        source = model(spark, params)
        shape = source.drop(source_param) if source_param else source
    # unlike a plain build, the insert list is always that of the target; columns a
    # source lacks after an append are filled with NULL
    target_schema = tables.read_table(spark, name).schema
    if overwrite:
        param = next(c for c in params.columns if c not in ("partition_id", order_by))
        if config.on_schema_change != "ignore":
            keep = [] if source_param is None else [source.schema[source_param]]
            source = conform(source, type(target_schema)(target_schema.fields + keep))
        overwrite_table_buckets(spark, name, source, params, param, source_param)
    else:
        rows = conform(shape, target_schema) if config.on_schema_change != "ignore" else shape
        merge_table(
            spark,
            name,
            rows,
            config.unique_key,
            partition_scope=config.partition_scope,
            **config.merge_options(),
        )
    return "created" if fresh else "updated"


# ---- microbatches


def check_microbatch(partition: PartitionSpec | None, batch_size: str | None) -> None:
    if partition is None:
        raise ConfigError("microbatch needs a partition")
    if batch_size not in BATCH_SIZES:
        raise ConfigError(f"unknown batch_size {batch_size!r}")
    if partition.granularity != batch_size:
        raise ConfigError(
            f"microbatch needs a partition of its batch size, got {batch_size} and {partition.granularity}"
        )


def batch_start(moment: datetime.datetime, batch_size: str) -> datetime.datetime:
    """Start of the batch that holds a moment."""
    fields = {"hour": {}, "day": {"hour": 0}, "month": {"hour": 0, "day": 1}, "year": {"hour": 0, "day": 1, "month": 1}}
    return moment.replace(minute=0, second=0, microsecond=0, **fields[batch_size])


def next_batch(start: datetime.datetime, batch_size: str) -> datetime.datetime:
    if batch_size in ("hour", "day"):
        return start + datetime.timedelta(**{f"{batch_size}s": 1})
    if batch_size == "month":
        return (start.replace(day=1) + datetime.timedelta(days=32)).replace(day=1)
    return start.replace(year=start.year + 1)


def batch_windows(begin: datetime.datetime, end: datetime.datetime, batch_size: str) -> list[tuple]:
    """Aligned ``[start, end)`` windows that cover ``begin`` up to ``end``."""
    out, start = [], batch_start(begin, batch_size)
    while start < end:
        stop = next_batch(start, batch_size)
        out.append((start, stop))
        start = stop
    return out


def _whole_batches(begin, end, batch_size) -> tuple:
    windows = batch_windows(begin, end, batch_size)
    return (windows[0][0], windows[-1][1]) if windows else (begin, begin)


def microbatch(
    target: DataFrame,
    source: DataFrame,
    event_time: str,
    batch_size: str,
    begin: datetime.datetime,
    end: datetime.datetime,
    partition: PartitionSpec,
) -> DataFrame:
    """The target after all batches between ``begin`` and ``end`` were run.

    Batches cover whole partitions, so running them one by one and replacing the union of
    their partitions at once give the same table; this is the latter, in one plan.
    """
    check_microbatch(partition, batch_size)
    start, stop = _whole_batches(begin, end, batch_size)
    return insert_overwrite(target, event_time_filter(source, event_time, start, stop), partition)


def previous_batch(start: datetime.datetime, batch_size: str) -> datetime.datetime:
    """Start of the batch before the one that starts at ``start``."""
    return batch_start(start - datetime.timedelta(hours=1), batch_size)


def newest_batch(spark: SparkSession, name: str) -> datetime.datetime | None:
    """Start of the newest stored partition, read from the catalog alone."""
    newest = tables.list_partitions(spark, name).agg(F.max("partition_id")).first()[0]
    return None if newest is None else datetime.datetime.fromisoformat(newest)


def _build_microbatch(spark, name, model, config: BuildConfig, exists: bool, now, batches) -> str:
    """Run the batches asked for: a range, or from ``lookback`` before the newest stored one up to now."""
    begin, end = config.begin, now or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    if batches is not None:
        begin, end = batches
    elif exists and (newest := newest_batch(spark, name)) is not None:
        for _ in range(config.lookback):
            newest = previous_batch(newest, config.batch_size)
        begin = max(begin, newest)
    start, stop = _whole_batches(begin, end, config.batch_size)
    target = tables.read_table(spark, name) if exists else None
    rows = config.shape(event_time_filter(model(spark, target), config.event_time, start, stop))
    if not exists:
        tables.create_table_as(rows, name, config.partition, config.cluster_by)
        return "created"
    overwrite_table(spark, name, rows)
    return "updated"


def recompute_dirty(
    spark: SparkSession, name: str, source: DataFrame, partition_ids: Sequence[str] | DataFrame | None
) -> None:
    """Rebuild the changed partitions of a stored table: ``None`` rebuilds all, an empty list none.

    The ids are a list or a one-column DataFrame, which the driver reads only while it is short.
    """
    partition, cluster_by = tables.table_layout(spark, name)
    if partition_ids is None:
        tables.create_table_as(source, name, partition, cluster_by, tables.key_buckets(spark, name))
        return
    if not isinstance(partition_ids, DataFrame):
        partition_ids = spark.createDataFrame([(i,) for i in partition_ids], "id string")
    with staging(spark):
        _replace_named(spark, name, source, partition, key_set(partition_ids))
