import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators.snapshot import SnapshotColumns, snapshot
from tidemark.plans.snapshots import snapshot_table
from tidemark.sources import tables

T0 = datetime.datetime(2024, 1, 1)
DAY = datetime.timedelta(days=1)


def fact(spark, ids, moved=()):
    rows = [(i, f"n{i}", T0 + (DAY if i in moved else 0 * DAY), (f"f{i}", i), [f"t{i}"]) for i in ids]
    return spark.createDataFrame(
        rows, "id int, name string, updated_at timestamp_ntz, contact struct<first: string, rank: int>, tags array<string>"
    )


def run(current, source, n=1, **options):
    options = {"strategy": "timestamp", "updated_at": "updated_at", "hard_deletes": "invalidate", **options}
    return snapshot(current, source, "id", now=T0 + n * DAY, **options)


def ids(df):
    current = sorted({r["id"] for r in df.where("valid_to is null").collect()})
    closed = sorted({r["id"] for r in df.where("valid_to is not null").collect()})
    return current, closed


def test_updates(spark):
    first = run(None, fact(spark, range(1, 21)))
    assert ids(run(first, fact(spark, range(1, 21), range(16, 21)))) == (list(range(1, 21)), list(range(16, 21)))


def test_inserts(spark):
    first = run(None, fact(spark, range(1, 21)))
    assert ids(run(first, fact(spark, range(1, 31)))) == (list(range(1, 31)), [])


def test_deletes_and_revives(spark):
    first = run(None, fact(spark, range(1, 21)))
    second = run(first, fact(spark, range(1, 16)))
    assert ids(second) == (list(range(1, 16)), list(range(16, 21)))
    assert ids(run(second, fact(spark, range(1, 19)), 2)) == (list(range(1, 19)), list(range(16, 21)))


def test_ignored_deletes_stay_open(spark):
    first = run(None, fact(spark, range(1, 6)))
    assert ids(run(first, fact(spark, [1]), hard_deletes="ignore")) == ([1, 2, 3, 4, 5], [])


def test_new_column_opens_no_versions_by_itself(spark):
    first = run(None, fact(spark, range(1, 21)))
    wider = fact(spark, range(1, 21), range(11, 21)).withColumn("full_name", F.when(F.col("id") > 10, F.col("name")))
    second = run(first, wider)
    assert ids(second) == (list(range(1, 21)), list(range(11, 21)))
    assert second.where("full_name is not null").count() == 10


def test_unchanged_source_changes_nothing(spark, rows):
    first = run(None, fact(spark, range(1, 6)))
    assert rows(run(first, fact(spark, range(1, 6)))) == rows(first)


def test_deletion_markers(spark):
    new_record = {"hard_deletes": "new_record"}
    first = run(None, fact(spark, range(1, 6)), **new_record)
    second = run(first, fact(spark, range(1, 4)), **new_record)
    assert ids(second) == ([1, 2, 3, 4, 5], [4, 5])
    assert sorted(r["id"] for r in second.where("is_deleted = 'True'").collect()) == [4, 5]
    # nothing more happens while the key stays away
    again = run(second, fact(spark, range(1, 4)), 2, **new_record)
    assert again.count() == second.count()
    third = run(again, fact(spark, range(1, 5)), 3, **new_record)
    assert ids(third) == ([1, 2, 3, 4, 5], [4, 5])
    four = third.where("id = 4 and valid_to is null").collect()
    assert len(four) == 1 and four[0]["is_deleted"] == "False"


def test_new_struct_column_with_deletion_markers(spark):
    first = run(None, fact(spark, range(1, 6)), hard_deletes="new_record")
    extra = F.struct(F.col("name"), F.col("id").alias("rank"))
    second = run(first, fact(spark, range(1, 4)).withColumn("extra", extra), hard_deletes="new_record")
    assert ids(second) == ([1, 2, 3, 4, 5], [4, 5])
    assert second.schema["extra"].dataType.simpleString() == "struct<name:string,rank:int>"


def test_markers_can_be_added_later(spark):
    first = run(None, fact(spark, [1, 2]))
    second = run(first, fact(spark, [1]), hard_deletes="new_record")
    assert sorted((r["id"], r["is_deleted"]) for r in second.collect()) == [(1, "False"), (2, "False"), (2, "True")]


def test_check_compares_nulls_as_values(spark):
    options = {"strategy": "check", "check_cols": "all", "updated_at": None}
    first = run(None, fact(spark, range(1, 6)), **options)
    nulled = fact(spark, range(1, 6)).withColumn("name", F.when(F.col("id") != 2, F.col("name")))
    second = run(first, nulled, **options)
    assert ids(second) == ([1, 2, 3, 4, 5], [2])
    assert ids(run(second, nulled, 2, **options)) == ([1, 2, 3, 4, 5], [2])
    some = run(first, nulled, strategy="check", check_cols=["tags", "contact"], updated_at=None)
    assert ids(some) == ([1, 2, 3, 4, 5], [])


def test_stored_snapshot(spark, table):
    def step(source, n):
        return snapshot_table(
            spark, table, source, "id", now=T0 + n * DAY, strategy="timestamp", updated_at="updated_at",
            hard_deletes="new_record" if n > 2 else "invalidate",
        )

    assert step(fact(spark, range(1, 6)), 0) == "created"
    assert step(fact(spark, range(1, 5), [2]), 1) == "updated"
    step(fact(spark, range(1, 5), [2]), 1)  # a repeated run changes nothing more
    stored = tables.read_table(spark, table)
    assert ids(stored) == ([1, 2, 3, 4], [2, 5]) and stored.count() == 6
    extra = F.struct(F.col("id").alias("n"))
    step(fact(spark, range(1, 6), [2]).withColumn("extra", extra), 2)
    stored = tables.read_table(spark, table)
    assert ids(stored) == ([1, 2, 3, 4, 5], [2, 5])
    assert {(r["id"], r["extra"] is None) for r in stored.where("valid_to IS NULL").collect()} == {
        (1, True), (2, True), (3, True), (4, True), (5, False)
    }
    wider = F.struct(F.col("id").alias("n"), F.lit("x").alias("more"))
    step(fact(spark, [1, 2, 6], [2]).withColumn("extra", wider), 3)
    stored = tables.read_table(spark, table)
    assert stored.schema["extra"].dataType.simpleString() == "struct<n:int,more:string>"
    assert ids(stored) == ([1, 2, 3, 4, 5, 6], [2, 3, 4, 5])
    assert stored.where("is_deleted = 'True'").count() == 3
    step(fact(spark, []).withColumn("extra", wider), 4)
    assert tables.read_table(spark, table).where("valid_to IS NULL AND is_deleted = 'False'").count() == 0


def test_repeated_source_key(spark):
    first = run(None, fact(spark, [1, 2]))
    with pytest.raises(Exception, match="more than once"):
        run(first, fact(spark, [1, 1])).collect()


def test_column_names_can_be_chosen(spark):
    names = SnapshotColumns(row_id="rid", valid_from="since", valid_to="until", updated_at="version")
    made = run(None, fact(spark, [1]), columns=names)
    assert {"rid", "since", "until", "version"} <= set(made.columns)
    assert run(made, fact(spark, [1], [1]), columns=names).count() == 2


@pytest.mark.parametrize(
    "options",
    [
        {"strategy": "other"},
        {"hard_deletes": "drop"},
        {"updated_at": None},
        {"strategy": "check", "check_cols": None},
    ],
)
def test_invalid_options(spark, options):
    with pytest.raises(ConfigError):
        run(None, fact(spark, [1]), **options)
    with pytest.raises(ConfigError):
        snapshot(None, fact(spark, [1]), [], strategy="timestamp", updated_at="updated_at")


def test_runs_at_the_same_time_keep_all_history(spark, table):
    from tidemark.plans.snapshots import snapshot_table
    from tidemark.sources import tables

    now = [datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)]
    make = lambda *rows: spark.createDataFrame(list(rows), "id int, v string")
    run = lambda df, at: snapshot_table(spark, table, df, "id", strategy="check", check_cols=["v"], now=at)
    run(make((1, "a"), (2, "a")), now[0])
    run(make((1, "b"), (2, "a")), now[1])
    run(make((1, "b"), (2, "c")), now[1])
    run(make((1, "b"), (2, "c")), now[1])  # nothing new
    got = sorted((r["id"], r["v"], r["valid_to"] is None) for r in tables.read_table(spark, table).collect())
    assert got == [(1, "a", False), (1, "b", True), (2, "a", False), (2, "c", True)]
