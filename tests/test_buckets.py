"""Tables in hash buckets of their key: merges, digests, comparisons and snapshots that leave other buckets alone."""

import datetime
import glob
import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators import buckets
from tidemark.operators.buckets import KeyBuckets
from tidemark.operators.changes import snapshot_diff
from tidemark.operators.merge import merge
from tidemark.operators.partition import IntRange, PartitionSpec
from tidemark.operators.quality import relation_diff
from tidemark.plans import digests
from tidemark.plans.incremental import BuildConfig, build_incremental, merge_table, overwrite_table
from tidemark.plans.snapshots import snapshot_table
from tidemark.sources import tables

SCHEMA = "id long, kind string, value double"
BY_ID = KeyBuckets(("id",), 16)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def files(spark, name):
    """Data files of a table by partition folder."""
    place = urlparse(tables.location(spark, name)).path
    found = {}
    for path in glob.glob(f"{place}/*/*.parquet"):
        folder, file = path.split("/")[-2:]
        found.setdefault(folder.split("=")[1], set()).add(file)
    return found


def stored(spark, name):
    return sorted((tuple(r) for r in tables.read_table(spark, name).collect()), key=str)


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def numbers(spark, count):
    return frame(spark, [(i, "a", float(i)) for i in range(count)] + [(None, "n", 1.0), (None, "n", 2.0)])


def test_a_merge_touches_the_buckets_of_its_keys(spark, table):
    first = numbers(spark, 5000)
    tables.create_table_as(first, table, buckets=BY_ID)
    before = files(spark, table)
    assert len(before) == 17
    source = frame(spark, [(17, "b", -1.0), (4999, "b", -2.0), (10**9, "new", 0.0)])
    merge_table(spark, table, source, "id")
    assert stored(spark, table) == ordered(merge(first, source, "id"))
    after = files(spark, table)
    ids = {r[0] for r in source.select(BY_ID.id_expr(source.schema)).collect()}
    assert {b for b in after if after[b] != before.get(b)} == ids
    assert tables.key_buckets(spark, table) == BY_ID


@pytest.mark.parametrize("null_safe", [False, True])
def test_null_keys(spark, table, null_safe):
    first = frame(spark, [(i, "a", float(i)) for i in range(300)] + [(None, "n", 1.0)])
    tables.create_table_as(first, table, buckets=BY_ID)
    before = files(spark, table)
    source = frame(spark, [(3, "b", -1.0), (None, "n", 5.0)])
    merge_table(spark, table, source, "id", null_safe=null_safe)
    assert stored(spark, table) == ordered(merge(first, source, "id", null_safe=null_safe))
    after = files(spark, table)
    touched = {b for b in after if after[b] != before[b]}
    assert touched == {source.where("id = 3").select(BY_ID.id_expr(source.schema)).first()[0], buckets.NO_KEY}
    # a key without NULL matches nothing there, so its file is kept and another added
    assert (before[buckets.NO_KEY] <= after[buckets.NO_KEY]) is not null_safe


def test_options_deletes_and_types(spark, table):
    first = numbers(spark, 400)
    tables.create_table_as(first, table, buckets=BY_ID)
    source = frame(spark, [(i, "b", 0.0) for i in range(0, 800, 50)]).withColumn("id", F.col("id").cast("int"))
    options = {"update_columns": ["value"], "predicates": ("dest.value > 100",), "skip_unchanged": True}
    expected = ordered(merge(first, source, "id", **options))
    merge_table(spark, table, source, "id", **options)
    assert stored(spark, table) == expected
    with pytest.raises(Exception, match="more than one source row"):
        merge_table(spark, table, frame(spark, [(1, "x", 0.0), (1, "y", 0.0)]), "id")
    assert stored(spark, table) == expected
    merge_table(spark, table, source.limit(0), "id")
    assert stored(spark, table) == expected


def test_another_key_rewrites_and_keeps_the_layout(spark, table):
    first = numbers(spark, 100)
    tables.create_table_as(first, table, buckets=BY_ID)
    source = frame(spark, [(1000, "z", 5.0)])
    expected = ordered(merge(first.where("value <> 5 or id is null"), source, "value"))
    merge_table(spark, table, source, "value")
    assert stored(spark, table) == sorted(
        [tuple(r) for r in merge(first, source, "value").collect()], key=str
    ) and len(expected) <= 102
    assert tables.key_buckets(spark, table) == BY_ID
    # a longer key than that of the layout is enough
    before = files(spark, table)
    merge_table(spark, table, frame(spark, [(7, "a", 70.0)]), ["id", "kind"])
    assert sum(before[b] != v for b, v in files(spark, table).items()) == 1


def test_random_merges_equal_the_operator(spark, table):
    rnd = random.Random(2)
    state = frame(spark, [(rnd.choice([None, *range(40)]), "s", float(i)) for i in range(60)]).dropDuplicates(["id"])
    tables.create_table_as(state, table, buckets=KeyBuckets(("id",), 8))
    for turn in range(3):
        source = frame(spark, [(i, "t", float(turn)) for i in rnd.sample(range(60), 9)] + [(None, "t", float(turn))])
        safe = turn == 1
        expected = ordered(merge(tables.read_table(spark, table), source, "id", null_safe=safe))
        merge_table(spark, table, source, "id", null_safe=safe)
        assert stored(spark, table) == expected


def test_zeros_and_nan_share_buckets(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "id double")
    ids = [r[0] for r in df.select(BY_ID.id_expr(df.schema)).collect()]
    assert ids[0] == ids[1] and ids[2] == ids[3]


def test_builds_clones_and_refusals(spark, table):
    config = BuildConfig("merge", unique_key="id", key_buckets=16)
    first, second = numbers(spark, 50), frame(spark, [(3, "b", 1.0), (70, "b", 1.0)])
    assert build_incremental(spark, table, lambda s, target: first, config) == "created"
    assert build_incremental(spark, table, lambda s, target: second, config) == "updated"
    assert stored(spark, table) == ordered(merge(first, second, "id"))
    tables.clone(spark, table, f"{table}_c")
    assert tables.key_buckets(spark, f"{table}_c") == KeyBuckets(("id",), 16)
    assert tables.relayout(spark, f"{table}_c", None, buckets=KeyBuckets(("id",), 5))
    assert not tables.relayout(spark, f"{table}_c", None, buckets=KeyBuckets(("id",), 5))
    assert stored(spark, f"{table}_c") == stored(spark, table)
    with pytest.raises(ConfigError):
        overwrite_table(spark, table, second)
    for wrong in (
        BuildConfig("merge", key_buckets=4),
        BuildConfig("merge", unique_key="id", key_buckets=4, partition=PartitionSpec("ts")),
    ):
        with pytest.raises(ConfigError):
            wrong.check()
    with pytest.raises(ConfigError):
        KeyBuckets(("id",), 10**6)
    assert [buckets.bucket_count(n << 20) for n in (0, 512, 513, 3000)] == [1, 1, 2, 8]


def test_undated_rows_are_one_partition_more(spark, table):
    spec = PartitionSpec("value", "int64", range=IntRange(0, 100, 10))
    first = spark.createDataFrame([(i, "a", i) for i in range(100)] + [(200, "a", None), (201, "a", None)], "id long, kind string, value long")
    tables.create_table_as(first, table, spec)
    before = files(spark, table)
    source = spark.createDataFrame([(5, "b", 7), (200, "b", 44), (300, "b", None)], first.schema)
    merge_table(spark, table, source, "id", partition_scope="all")
    assert stored(spark, table) == ordered(merge(first, source, "id"))
    after = files(spark, table)
    assert {b for b in after if after[b] != before[b]} == {"0", "40", "__HIVE_DEFAULT_PARTITION__"}
    # the last rows without a value move away
    source = spark.createDataFrame([(201, "c", 1), (300, "c", 2)], first.schema)
    expected = ordered(merge(tables.read_table(spark, table), source, "id", null_safe=True))
    merge_table(spark, table, source, "id", partition_scope="all", null_safe=True)
    assert stored(spark, table) == expected
    assert "__HIVE_DEFAULT_PARTITION__" not in files(spark, table)


def test_digests_tell_rows_apart(spark):
    def digest(rows, schema):
        return spark.createDataFrame(rows, schema).transform(
            lambda df: buckets.digests(df, F.lit("x"), df.columns)
        ).first()

    schema = "a string, b string, s struct<x:string,y:string>, l array<string>"
    base = [("1", None, ("p", None), ["a", None]), (None, "1", None, [])]
    same = digest(list(reversed(base)), schema)
    assert digest(base, schema) == same
    for other in (
        [(None, "1", ("p", None), ["a", None]), (None, "1", None, [])],
        [("1", None, (None, "p"), ["a", None]), (None, "1", None, [])],
        [("1", None, ("p", None), [None, "a"]), (None, "1", None, [])],
        [("1", None, ("p", None), ["a", None]), (None, "1", (None, None), [])],
        [("1", None, ("p", None), ["a", None]), (None, "1", None, None)],
        base + base[:1], base[:1], base + base + base[:1],
    ):
        assert digest(other, schema) != same


def folders(df):
    return {path.split(f"{tables.BUCKET}=")[1].split("/")[0] for path in df.inputFiles()}


def test_diffs_read_the_buckets_that_differ(spark, table):
    first = numbers(spark, 2000).where("id is not null")
    tables.create_table_as(first, f"{table}_a", buckets=BY_ID)
    tables.create_table_as(first, f"{table}_b", buckets=BY_ID)
    assert digests.stored_diff(spark, f"{table}_a", f"{table}_b", "id").count() == 0
    source = frame(spark, [(11, "b", 0.5)])
    merge_table(spark, f"{table}_b", source, "id")
    one = source.select(BY_ID.id_expr(source.schema)).first()[0]
    diff = digests.stored_diff(spark, f"{table}_a", f"{table}_b", "id")
    assert folders(diff) == {one}
    after = tables.read_table(spark, f"{table}_b")
    assert ordered(diff) == ordered(snapshot_diff(first, after, "id")) and diff.count() == 1
    relation = digests.stored_relation_diff(spark, f"{table}_a", f"{table}_b")
    assert folders(relation) == {one}
    assert relation.collect() == relation_diff(first, after).collect()


def test_digests_follow_any_writer(spark, table):
    first = numbers(spark, 300)
    tables.create_table_as(first, f"{table}_a", buckets=BY_ID)
    tables.create_table_as(first, f"{table}_b", buckets=BY_ID)
    before = {r["bucket"]: r for r in digests.table_digests(spark, f"{table}_b").collect()}
    assert sum(r["row_count"] for r in before.values()) == 302
    tables.append_rows(frame(spark, [(5, "more", 0.0)]), f"{table}_b")
    after = {r["bucket"]: r for r in digests.table_digests(spark, f"{table}_b").collect()}
    assert sum(before[b] != r for b, r in after.items()) == 1
    assert digests.stored_relation_diff(spark, f"{table}_a", f"{table}_b").first()["row_count_difference"] == -1
    tables.drop_partitions(spark, f"{table}_b", [buckets.NO_KEY])
    assert buckets.NO_KEY not in {r["bucket"] for r in digests.table_digests(spark, f"{table}_b").collect()}
    changed = digests.changed_buckets(spark, f"{table}_a", f"{table}_b")
    assert buckets.NO_KEY in {r[0] for r in changed.collect()} and changed.count() == 2
    # a column that only one side has makes every row differ
    tables.add_table_columns(spark, f"{table}_b", frame(spark, []).select(F.lit(1).alias("extra")).schema.fields)
    assert sum(r["file_mark"] == after.get(r["bucket"], r)["file_mark"] for r in digests.table_digests(spark, f"{table}_b").collect()) == 0
    with pytest.raises(ConfigError):
        digests.stored_diff(spark, f"{table}_a", f"{table}_b", "value")


@pytest.mark.parametrize(
    "options",
    [
        {"strategy": "check", "check_cols": "all", "hard_deletes": "invalidate"},
        {"strategy": "check", "check_cols": ["value"], "hard_deletes": "new_record"},
        {"strategy": "timestamp", "updated_at": "at"},
    ],
)
def test_snapshots_read_changed_buckets(spark, table, options):
    day = lambda n: datetime.datetime(2024, 1, n)
    rnd = random.Random(5)
    rows = {i: (i, "a", float(i), day(1)) for i in range(120)}
    columns = [
        "id", "kind", "value", "at", "row_id", "valid_from", "valid_to",
        *(["is_deleted"] if options.get("hard_deletes") == "new_record" else []),
    ]
    for turn in range(2, 6):
        state = spark.createDataFrame(list(rows.values()), "id long, kind string, value double, at timestamp_ntz")
        if turn == 2:
            tables.create_table_as(state, f"{table}_s", buckets=BY_ID)
        else:
            # deletes need the buckets of the old keys too, so the state is written bucket by bucket
            spark.sql(f"DROP TABLE {table}_s")
            tables.create_table_as(state, f"{table}_s", buckets=BY_ID)
        now = day(turn)
        before = files(spark, f"{table}_x") if turn > 2 else {}
        digests.snapshot_stored(spark, f"{table}_x", f"{table}_s", "id", now=now, **options)
        snapshot_table(spark, f"{table}_y", state, "id", now=now, **options)
        left, right = (tables.read_table(spark, f"{table}_{n}").select(columns) for n in "xy")
        assert ordered(left) == ordered(right)
        if turn > 2:
            after = files(spark, f"{table}_x")
            changed_ids = spark.createDataFrame([(i,) for i in touched], "id long")
            ids = {r[0] for r in changed_ids.select(BY_ID.id_expr(changed_ids.schema)).collect()}
            opened = lambda found: {b: f for b, f in found.items() if b.startswith("open")}
            moved = {b for b in opened(before) if before[b] != after.get(b)}
            assert moved <= {f"open {i}" for i in ids} | {f"open%20{i}" for i in ids} and moved
        touched = set(rnd.sample(sorted(rows), 3))
        for n, i in enumerate(sorted(touched)):
            if n == 0 and turn < 5:
                del rows[i]
            else:
                rows[i] = (i, "b", rows[i][2] + 1000, day(turn + 1))
        if turn == 4:
            rows[900] = (900, "new", 1.0, day(5))
            touched.add(900)
    assert digests.snapshot_stored(spark, f"{table}_x", f"{table}_s", "id", now=day(9), **options) == "updated"
    assert ordered(tables.read_table(spark, f"{table}_x").select(columns)) == ordered(right)
