"""Change feeds, change pooling and the question which partitions are dirty."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.errors import ConfigError
from tidemark.operators.merge import HITS, check_comparable, col, differs, key_list
from tidemark.operators.partition import PartitionSpec, literal
from tidemark.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_small, key_set, split_by_keys
from tidemark.session import stage

CHANGE_TYPE = "_change_type"
CHANGE_TIME = "_change_timestamp"

# Statuses of a pooled table.
ADVANCING = ["initial", "ok", "out_of_range", "unpartitioned"]
AFFECTING = ["initial", "ok", "out_of_range", "unpartitioned"]

#: Windows are cut into units of at least 2^20 microseconds, about a second.
MIN_UNIT_BITS = 20

COUNTERS = ["rows_changed", "rows_insert", "rows_update", "rows_delete"]


def snapshot_diff(
    before: DataFrame,
    after: DataFrame,
    keys: str | Sequence[str],
    *,
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Row changes that lead from one state of a table to the next.

    Deleted rows show their old values, inserted and updated rows the new ones. Both
    states must hold one row per key; a repeated key raises an error when the plan runs.
    """
    names = key_list(keys)
    columns = after.columns
    values = [c for c in columns if c not in names]
    compare = list(compare or values)
    check_comparable(after.schema, compare)

    def keyed(df: DataFrame) -> DataFrame:
        # structs of equal fields are equal, NULLs included; the count and the join share one shuffle by it
        rows = df.select(F.struct(*[col(k) for k in names]).alias("__key"), *[col(c) for c in columns])
        return rows.withColumn(HITS, F.count(F.lit(1)).over(Window.partitionBy("__key")))

    both = keyed(before).alias("old").join(
        keyed(after).alias("new"), F.col("old.__key") == F.col("new.__key"), "full_outer"
    )
    n_old, n_new = F.col(f"old.{HITS}"), F.col(f"new.{HITS}")
    kind = (
        F.when(n_old.isNull(), "INSERT")
        .when(n_new.isNull(), "DELETE")
        .when(differs([col(c, "old") for c in compare], [col(c, "new") for c in compare]), "UPDATE")
    )
    unique = F.assert_true(
        (F.coalesce(n_old, F.lit(1)) == 1) & (F.coalesce(n_new, F.lit(1)) == 1),
        "snapshot_diff: a key occurs more than once",
    ).isNull()
    changed = both.where(unique).withColumn(CHANGE_TYPE, kind).where(F.col(CHANGE_TYPE).isNotNull())
    deleted = F.col(CHANGE_TYPE) == "DELETE"
    return changed.select(
        *[F.when(deleted, col(c, "old")).otherwise(col(c, "new")).alias(c) for c in columns],
        CHANGE_TYPE,
    )


def between(df: DataFrame, start=None, end=None, time_column: str = CHANGE_TIME) -> DataFrame:
    """Rows of the half-open window ``[start, end)``; either side may be open."""
    if start is not None:
        df = df.where(col(time_column) >= literal(start))
    if end is not None:
        df = df.where(col(time_column) < literal(end))
    return df


def tag_partitions(changes: DataFrame, table: str, partition: PartitionSpec | None) -> DataFrame:
    """Change rows of one table in the form ``changes_agg`` takes for many tables."""
    ident = partition.id_expr() if partition is not None and partition.is_time else F.lit(None).cast("string")
    return changes.select(
        F.lit(table).alias("full_table_name"),
        col(CHANGE_TYPE),
        col(CHANGE_TIME),
        ident.alias("partition_id"),
    )


def _count_kinds() -> list[Column]:
    kind = col(CHANGE_TYPE)
    return [
        F.count(F.lit(1)).alias("rows_changed"),
        F.count_if(kind == "INSERT").alias("rows_insert"),
        F.count_if(kind == "UPDATE").alias("rows_update"),
        F.count_if(kind == "DELETE").alias("rows_delete"),
    ]


def changes_agg(changes: DataFrame, start=None, end=None) -> DataFrame:
    """Changed partitions and row counts of every table in ``[start, end)``, in one pass.

    ``changes`` has ``full_table_name``, ``_change_type``, ``_change_timestamp`` and
    ``partition_id``. Rows are first counted per table and partition, so even a table
    with most of the changes sends one row per partition and task into the shuffle.
    """
    if start is not None and end is not None:
        changes = changes.where(literal(start) < literal(end))
    per_partition = (
        between(changes, start, end)
        .groupBy("full_table_name", "partition_id")
        .agg(*_count_kinds())
    )
    return _fold_partitions(per_partition)


def _fold_partitions(per_partition: DataFrame, *more: Column) -> DataFrame:
    return per_partition.groupBy("full_table_name").agg(
        F.array_sort(F.collect_set("partition_id")).alias("partition_ids"),
        *[F.sum(c).alias(c) for c in COUNTERS],
        *more,
    )


def partition_kind(partition: PartitionSpec | None) -> tuple[str, str | None, str | None]:
    """(kind, granularity, field) of a table as stored in the registry."""
    if partition is None:
        return "none", None, None
    if not partition.is_time:
        return "integer", None, partition.field
    if partition.ingestion_time:
        hidden = "_PARTITIONTIME" if partition.granularity == "hour" else "_PARTITIONDATE"
        return "ingestion", partition.granularity, hidden
    return "time", partition.granularity, partition.field


def pool(
    registry: DataFrame,
    checkpoints: DataFrame,
    changes: DataFrame,
    end,
    *,
    history_start: DataFrame | None = None,
    feed_is_delta: bool = False,
) -> DataFrame:
    """Status and changes of every registered table up to ``end``, in one plan.

    ``registry``: ``full_table_name, partition_type, partition_granularity,
    partition_field`` and optionally ``found`` (false when the table is gone),
    ``meta_error`` (its description cannot be read) and ``read_error`` (its changes
    cannot be read). ``checkpoints``: ``full_table_name, delta_end_time`` (the watermark).
    ``changes``: as for ``changes_agg``. ``history_start``: ``full_table_name,
    oldest_change`` where older changes are no longer available.

    With ``feed_is_delta`` every row of ``changes`` is new, as in a stream: late rows count
    too, and the window is widened back to the earliest of them.
    """
    end = literal(end).cast("timestamp_ntz")
    # a table listed twice is pooled once, as it is listed first
    listing = first_rows(registry, "full_table_name")
    text = F.lit(None).cast("string")
    flags = {"found": F.lit(True), "meta_error": text, "read_error": text}
    listing = listing.withColumns({k: v for k, v in flags.items() if k not in registry.columns})
    marks = checkpoints.select("full_table_name", F.col("delta_end_time").alias("watermark"))
    tables = listing.join(marks, "full_table_name", "left")
    if history_start is not None:
        tables = tables.join(
            history_start.select("full_table_name", "oldest_change"), "full_table_name", "left"
        )
    else:
        tables = tables.withColumn("oldest_change", F.lit(None).cast("timestamp_ntz"))

    timed = F.col("partition_type").isin("time", "ingestion") & F.col("partition_granularity").isNotNull()
    mark = F.col("watermark")
    status = (
        F.when(mark >= end, "skipped")
        .when(~F.col("found"), "not_found")
        .when(F.col("meta_error").isNotNull(), "error")
        .when(mark.isNull(), "initial")
        .when(~F.coalesce(timed, F.lit(False)), "unpartitioned")
        .when(F.col("oldest_change") > mark, "out_of_range")
        .when(F.col("read_error").isNotNull(), "error")
        .otherwise("ok")
    )
    # one row per table; stored, as it picks the changes to read and carries the result
    tables = stage(tables.withColumn("status", status), "pool")

    # only tables that need their changes read reach the change feed
    windows = broadcast_if_small(
        tables.where(F.col("status") == "ok").select("full_table_name", "watermark")
    )
    if not feed_is_delta:
        # the scan reads no change before the earliest watermark; one row per table is asked
        oldest = windows.agg(F.min("watermark")).first()[0]
        changes = between(changes, oldest).where(col(CHANGE_TIME) < end)
    counted = changes.join(windows, "full_table_name")
    if not feed_is_delta:
        counted = counted.where((col(CHANGE_TIME) >= F.col("watermark")) & (col(CHANGE_TIME) < end))
    earliest = F.min(CHANGE_TIME).cast("timestamp_ntz").alias("earliest")
    counted = counted.groupBy("full_table_name", "partition_id").agg(*_count_kinds(), earliest)
    rows = tables.join(
        _fold_partitions(counted, F.min("earliest").alias("earliest")), "full_table_name", "left"
    )
    if feed_is_delta:
        mark = F.least(mark, F.col("earliest"))
    ok = F.col("status") == "ok"
    nothing = F.array().cast("array<string>")
    ids = F.when(ok, F.coalesce(F.col("partition_ids"), nothing))
    # a table that could not even be described leaves no log row
    logged = ~F.col("status").isin("skipped", "not_found") & F.col("meta_error").isNull()
    known = lambda c: F.when(logged, F.col(c)).alias(c)
    return rows.select(
        "full_table_name",
        "status",
        F.when(F.col("status") == "initial", end)
        .when(F.col("status") == "skipped", mark)
        .when(logged, mark)
        .alias("delta_start"),
        logged.alias("logged"),
        F.when(F.col("status") == "skipped", mark).otherwise(end).alias("delta_end"),
        known("partition_type"),
        known("partition_granularity"),
        known("partition_field"),
        ids.alias("partition_ids"),
        F.when(ok, F.size(F.coalesce(F.col("partition_ids"), nothing))).alias("partitions_changed_cnt"),
        *[F.when(ok, F.coalesce(F.col(c), F.lit(0))).alias(c) for c in COUNTERS],
        F.when(F.col("status") == "error", F.coalesce("meta_error", "read_error")).alias("error"),
    )


def first_rows(df: DataFrame, key: str) -> DataFrame:
    """The first row of each value of ``key``, by place; found in the map-side aggregate."""
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    row = F.min_by(F.struct(*[col(c) for c in df.columns]), "__place").alias("row")
    return placed.groupBy(col(key)).agg(row).select("row.*")


def pool_summary(results: DataFrame) -> DataFrame:
    """Number of pooled tables by status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def _days(df: DataFrame, start: str, end: str, bits: int | None = None) -> DataFrame:
    """The first and last calendar day a window touches, or, with ``bits``, the first and last unit of 2^``bits`` microseconds."""

    def place(name: str) -> Column:
        if bits is None:
            return F.unix_date(F.col(name).cast("date"))
        return F.shiftright(F.unix_micros(F.col(name).cast("timestamp")), bits)

    first, last = place(start), place(end)
    return df.withColumn("first_day", first).withColumn("last_day", F.greatest(first, last))


def _pieces_of_level(first: Column, last: Column, level: Column) -> list[tuple[Column, Column]]:
    """The stretches of one level that ``dyadic_pieces`` takes: (whether it is one of them, place), twice."""
    odd = lambda c: c.bitwiseAND(1)
    low = F.negative(F.call_function("shiftright", F.negative(first), level))
    high = F.call_function("shiftright", last + 1, level)
    return [((odd(low) == 1) & (low < high), low), ((odd(high) == 1) & (low + odd(low) < high), high - 1)]


def dyadic_pieces(first: Column, last: Column, top: int) -> list[tuple[Column, int, Column]]:
    """The fewest aligned stretches of 2^level days that make up ``first`` to ``last``, none longer than 2^``top``.

    Each is (whether it is one of them, level, place) and begins on day ``place * 2^level``. A window of n days, at
    most 2^(top+1) - 1, has at most ``2 * log2(n)`` of them, and one if n is 1.
    """
    return [(made, k, place) for k in range(top + 1) for made, place in _pieces_of_level(first, last, F.lit(k))]


def _meets(df: DataFrame, top: int, places: Sequence[Column]) -> DataFrame:
    """A row for each stretch of ``places`` that is not NULL, of each ``level`` up to ``top``.

    Levels are rows, since an expression that spells out all of them is too long to be compiled.
    """
    by_level = df.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    return by_level.withColumn("meet", F.explode(F.array(*places))).where("meet IS NOT NULL").drop("level")


def _spread(df: DataFrame, own_top: int, other_top: int, of_requests: bool) -> DataFrame:
    """A row for each piece of a window, to meet first days, and for each stretch around its first day, to meet pieces.

    ``meet`` numbers the stretch, and is odd where the first day is the request's.
    """
    first, last, level = F.col("first_day"), F.col("last_day"), F.col("level")

    def number(place: Column, request_begins: bool) -> Column:
        return place.cast("bigint") * 128 + 2 * level + int(request_begins)

    own = [
        F.when(made & (level <= own_top), number(place, not of_requests))
        for made, place in _pieces_of_level(first, last, level)
    ]
    around = F.when(level <= other_top, number(F.call_function("shiftright", first, level), of_requests))
    return _meets(df, max(own_top, other_top), [*own, around])


def _lengths(df: DataFrame, start: str, end: str, side: int) -> DataFrame:
    """Number, longest and usual length, as a power of two microseconds, of one side's windows."""
    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in (start, end))
    length = F.greatest(last - first, F.lit(0))
    return df.select(length.alias("length")).agg(
        F.lit(side).alias("side"),
        F.count(F.lit(1)).alias("rows"),
        F.max("length").alias("longest"),
        F.avg(F.log2(F.col("length") + 1)).alias("usual"),
    )


def _units(log: DataFrame, requests: DataFrame) -> tuple[int, list[int], list[int]]:
    """Size of a unit in bits, and the top level and number of windows of requests and log, found by one small job.

    Units are about as long as the log's windows usually are; where requests are far longer they grow with them, so
    that a usual request has 2^10 at most.
    """
    found = _lengths(requests, "start", "end", 0).unionByName(_lengths(log, "delta_start", "delta_end", 1))
    sizes = sorted(found.collect(), key=lambda r: r["side"])
    asked, told = (math.ceil(r["usual"] or 0) for r in sizes)
    bits = max(MIN_UNIT_BITS, told, asked - 10)
    top = [(((r["longest"] or 0) >> bits) + 2).bit_length() - 1 for r in sizes]
    return bits, top, [r["rows"] for r in sizes]


def _smaller_broadcast(left: DataFrame, right: DataFrame, rows: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Both sides; the one made of fewer rows is broadcast if it is small."""
    if min(rows) > MAX_BROADCAST_ROWS:
        return left, right
    return (broadcast_if_small(left), right) if rows[0] <= rows[1] else (left, broadcast_if_small(right))


def overlapping(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Every pair of a request and a log row of the same table whose windows overlap.

    Of two windows with a common moment, one begins within the other. Each is split into aligned stretches of
    2^k units of time, at most two of a length, and the first unit of each lies in one stretch of every length: a
    window of n units has ``2 * log2(n)`` rows, and as many as the other side has lengths, whatever it spans.
    Both sides are joined on table and stretch, so a busy table is split over many tasks, and a pair meets
    in one stretch only; of windows that begin in one unit the request counts as the later. Units are as long as
    log rows usually are, so that few rows in the units at the ends of a window are compared in vain. One small job
    finds the lengths, and the side with fewer windows is broadcast if it is small.
    """
    bits, top, rows = _units(log, requests)
    left, right = _smaller_broadcast(
        _spread(_days(requests, "start", "end", bits), top[0], top[1], True),
        _spread(_days(log, "delta_start", "delta_end", bits), top[1], top[0], False),
        rows,
    )
    return left.alias("r").join(
        right.alias("l"),
        (F.col("r.full_table_name") == F.col("l.full_table_name"))
        & (F.col("r.meet") == F.col("l.meet"))
        & ((F.col("r.meet").bitwiseAND(1) == 1) | (F.col("l.first_day") > F.col("r.first_day")))
        & (F.col("l.delta_start") < F.col("r.end"))
        & (F.col("l.delta_end") > F.col("r.start")),
    )


def _ids_by_stretch(log: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests and ids of the log by the stretch of time in which they meet, for sets of ids instead of pairs.

    A log row that begins between the first and the last unit of a request overlaps it for certain: for these the ids of
    a stretch are made distinct beforehand. Others keep their window to be compared: rows that begin in a request's first
    or last unit, and rows that reach over its beginning. A request and an id may meet more than once.
    """
    bits, top, rows = _units(log, requests)
    first, last, level = F.col("first_day"), F.col("last_day"), F.col("level")
    around = F.call_function("shiftright", first, level)

    def number(place: Column, kind: int) -> Column:
        return place.cast("bigint") * 256 + 4 * level + kind

    inside, edge, over = 0, 1, 2
    asked = [
        *[F.when(made & (level <= top[0]), number(place, inside)) for made, place in _pieces_of_level(first + 1, last - 1, level)],
        F.when(level == 0, number(first, edge)),
        F.when((level == 0) & (last > first), number(last, edge)),
        F.when(level <= top[1], number(around, over)),
    ]
    left = _meets(_days(requests, "start", "end", bits), max(top), asked)

    told = [
        *[F.when(made & (level <= top[1]), number(place, over)) for made, place in _pieces_of_level(first, last, level)],
        F.when(level == 0, number(first, edge)),
        F.when(level <= top[0], number(around, inside)),
    ]
    entries = _days(log, "delta_start", "delta_end", bits).select(
        "*", F.col("partition_ids").isNull().alias("whole"), F.explode_outer("partition_ids").alias("id")
    )
    met = _meets(entries.where("whole OR id IS NOT NULL"), max(top), told)
    sure = (F.col("meet").bitwiseAND(3) == inside) & F.coalesce(F.col("delta_end") >= F.col("delta_start"), F.lit(False))
    window = [F.when(~sure, F.col(c)).alias(c) for c in ("delta_start", "delta_end")]
    # a NULL list stands for all ids, whatever else is in the stretch
    right = met.groupBy("full_table_name", "meet", *window).agg(
        F.bool_or("whole").alias("whole"), F.collect_set("id").alias("ids")
    )
    return _smaller_broadcast(left, right.withColumn("ids", F.when(~F.col("whole"), F.col("ids"))), rows)


def affected_partitions(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Partitions each request must treat as changed.

    ``log``: ``full_table_name, status, delta_start, delta_end, partition_ids``.
    ``requests``: ``request_id, full_table_name, start, end``. The result has one row
    per request with ``partition_ids``: NULL for "all", ``[]`` for "none".

    A log row counts if its window overlaps ``[start, end)``. Ids are made distinct per stretch of
    time before the join, and per request before any list of a request is built.
    """
    entries = log.where(F.col("status").isin(AFFECTING)).select(
        "full_table_name", "delta_start", "delta_end", "partition_ids"
    )
    asked, told = _ids_by_stretch(entries, requests)
    hits = asked.alias("r").join(
        told.alias("l"),
        (F.col("r.full_table_name") == F.col("l.full_table_name"))
        & (F.col("r.meet") == F.col("l.meet"))
        & (
            F.col("l.delta_start").isNull()
            | ((F.col("l.delta_start") < F.col("r.end")) & (F.col("l.delta_end") > F.col("r.start")))
        ),
    )
    # a NULL list becomes one row without an id but with the flag set
    spread = hits.select("r.request_id", "l.whole", F.explode_outer("l.ids").alias("id")).distinct()
    folded = spread.groupBy("request_id").agg(
        F.bool_or("whole").alias("whole"), F.array_sort(F.collect_set("id")).alias("ids")
    )
    none = F.array().cast("array<string>")
    return requests.join(folded, "request_id", "left").select(
        *[col(c) for c in requests.columns],
        F.when(F.col("whole"), F.lit(None)).otherwise(F.coalesce(F.col("ids"), none)).alias("partition_ids"),
    )


def window_coverage(requests: DataFrame, checkpoints: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Whether the pooled changes reach the end of each request's window."""
    marks = checkpoints.select("full_table_name", F.col("delta_end_time").alias("watermark"))
    base = affected_partitions(log, requests) if log is not None else requests
    late = F.col("watermark").isNull() | (F.col("watermark") < F.col("end"))
    return base.join(marks, "full_table_name", "left").withColumn(
        "coverage", F.when(late, "incomplete").otherwise("complete")
    )


def require_covered(coverage: DataFrame) -> DataFrame:
    """The same rows; a request that is still incomplete raises an error when the plan runs."""
    covered = F.assert_true(
        F.col("coverage") == "complete", "changes are not pooled up to the end of the window"
    ).isNull()
    return coverage.where(covered)


def dirty_rows(source: DataFrame, partition: PartitionSpec, partition_ids: Sequence[str] | DataFrame | None) -> DataFrame:
    """Source rows that lie in changed partitions: ``None`` keeps all, an empty list none."""
    if partition_ids is None:
        return source
    if isinstance(partition_ids, DataFrame):
        return split_by_keys(source, partition.id_expr(), partition_ids, partition.span(source))[0]
    ids = source.sparkSession.createDataFrame([(i,) for i in partition_ids], "id string")
    return split_by_keys(source, partition.id_expr(), ids, partition.span(source))[0]


def dirty_recompute(
    target: DataFrame,
    source: DataFrame,
    partition: PartitionSpec,
    partition_ids: Sequence[str] | DataFrame | None,
) -> DataFrame:
    """The target with its changed partitions rebuilt from the source and all others kept.

    A changed partition without source rows becomes empty.
    """
    if partition_ids is None:
        return source.select([col(c) for c in target.columns])
    ident = partition.id_expr()
    if not isinstance(partition_ids, DataFrame):
        partition_ids = source.sparkSession.createDataFrame([(i,) for i in partition_ids], "id string")
    dirty = key_set(partition_ids)
    _, kept = split_by_keys(target, ident, dirty)
    rows, _ = split_by_keys(source, ident, dirty, partition.span(source))
    return kept.unionByName(rows.select([col(c) for c in target.columns]))


def changed_partitions(changes: DataFrame, partition: PartitionSpec) -> DataFrame:
    """Distinct partition ids of a change feed, as a one-column DataFrame."""
    return changes.select(partition.id_expr().alias("partition_id")).where("partition_id is not null").distinct()


def first_per_name(relations: Sequence[Mapping[str, str]]) -> list[Mapping[str, str]]:
    """Relations without repeats of the same full name; the first one stays."""
    seen: dict[str, Mapping[str, str]] = {}
    for relation in relations:
        try:
            name = ".".join(relation[k] for k in ("database", "schema", "identifier"))
        except KeyError as exc:
            raise ConfigError(f"relation lacks {exc}") from exc
        seen.setdefault(name, relation)
    return list(seen.values())
