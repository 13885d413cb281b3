import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.operators.merge import merge
from tidemark.operators.partition import PartitionSpec

DAY1, DAY2 = datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2)


def pair(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id long, name string, n long")
    source = spark.createDataFrame([(2, "B", 2), (3, "c", 3), (4, "d", 4)], "id long, name string, n long")
    return target, source


def test_upsert(spark, rows):
    assert rows(merge(*pair(spark), "id")) == [(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", 4)]


@pytest.mark.parametrize("key", [None, "", []])
def test_no_key_appends(spark, key):
    assert merge(*pair(spark), key).count() == 6


def test_column_subsets(spark, rows):
    target, source = pair(spark)
    source = source.withColumn("n", F.col("n") * 10)
    assert rows(merge(target, source, "id", update_columns=["n"])) == [
        (1, "a", 1), (2, "b", 20), (3, "c", 30), (4, "d", 40)
    ]
    assert rows(merge(target, source, "id", exclude_columns=["N"])) == [
        (1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", 40)
    ]
    with pytest.raises(ConfigError):
        merge(target, source, "id", update_columns=["n"], exclude_columns=["name"])


def test_insert_list(spark, rows):
    target, source = pair(spark)
    assert rows(merge(target, source.drop("n"), "id", dest_columns=["id", "name"])) == [
        (1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", None)
    ]
    with pytest.raises(ConfigError):
        merge(target, source.drop("n"), "id")


def test_null_key_golden(spark, rows):
    target = spark.createDataFrame([(None, "a"), (1, "b")], "id long, name string")
    source = spark.createDataFrame([(None, "a_updated"), (1, "b_updated")], "id long, name string")
    assert rows(merge(target, source, "id", null_safe=True)) == [(None, "a_updated"), (1, "b_updated")]
    assert rows(merge(target, source, "id")) == [(None, "a"), (None, "a_updated"), (1, "b_updated")]
    # a list of keys always compares with plain equality
    assert merge(target, source, ["id"], null_safe=True).count() == 3


def test_several_null_source_keys_without_null_safety(spark):
    target = spark.createDataFrame([(None, "a")], "id long, name string")
    source = spark.createDataFrame([(None, "x"), (None, "y")], "id long, name string")
    assert merge(target, source, "id").count() == 3
    with pytest.raises(Exception, match="more than one source row"):
        merge(target, source, "id", null_safe=True).collect()


def test_several_source_rows_for_a_target_row(spark):
    target, source = pair(spark)
    twice = source.unionByName(source)
    for action in ("collect", "count"):
        with pytest.raises(Exception, match="more than one source row"):
            getattr(merge(target, twice, "id"), action)()


def test_repeated_source_keys_that_match_nothing_are_inserted(spark):
    target, source = pair(spark)
    new = source.where("id = 4")
    assert merge(target, new.unionByName(new).unionByName(new), "id").count() == 6


def test_one_source_row_updates_all_its_target_rows(spark, rows):
    target, source = pair(spark)
    doubled = target.unionByName(target)
    assert rows(merge(doubled, source.where("id = 2"), "id"), "name") == [("B",), ("B",), ("a",), ("a",), ("c",), ("c",)]


def test_skip_unchanged_rules(spark, rows):
    target, source = pair(spark)
    changed = source.withColumn("n", F.col("n") + 10)
    kept = merge(target, changed, "id", skip_unchanged=True, stable_columns=["id", "name"])
    assert rows(kept) == [(1, "a", 1), (2, "B", 12), (3, "c", 3), (4, "d", 14)]
    for bad in (
        {"stable_columns": ["name"], "unstable_columns": ["n"]},
        {"stable_columns": ["missing"]},
        {"stable_columns": ["id"]},
        {"unstable_columns": ["name", "n"]},
    ):
        with pytest.raises(ConfigError):
            merge(target, changed, "id", skip_unchanged=True, **bad)
    with pytest.raises(ConfigError):
        merge(target, changed, None, skip_unchanged=True)


def test_uncomparable_columns_are_refused(spark):
    target = spark.sql("SELECT 1 AS id, map('a', 1) AS m")
    with pytest.raises(ConfigError, match="map or variant"):
        merge(target, target, "id", skip_unchanged=True)
    variant = spark.sql("SELECT 1 AS id, parse_json('1') AS v, 2 AS n")
    with pytest.raises(ConfigError):
        merge(variant, variant, "id", skip_unchanged=True)
    assert merge(variant, variant, "id", skip_unchanged=True, unstable_columns=["v"]).count() == 1


def test_struct_and_array_columns_compare(spark, rows):
    target = spark.sql("SELECT 1 AS id, named_struct('a', array(1, NULL)) AS s, 'old' AS tag")
    source = spark.sql("SELECT 1 AS id, named_struct('a', array(1, NULL)) AS s, 'new' AS tag")
    same = merge(target, source, "id", skip_unchanged=True, stable_columns=["s"])
    assert rows(same, "tag") == [("old",)]


def test_predicates_must_name_a_side(spark):
    with pytest.raises(ConfigError):
        merge(*pair(spark), "id", predicates=["n > 1"])


def test_null_predicate_is_not_a_match(spark):
    target = spark.createDataFrame([(1, None)], "id long, n long")
    source = spark.createDataFrame([(1, 5)], "id long, n long")
    assert merge(target, source, "id", predicates=["dest.n > 0"]).count() == 2


def test_moved_row_golden(spark, rows):
    """Ids 1-4 on the first day; 4 moves to the second day, 5 and 6 are new."""
    target = spark.createDataFrame([(i, DAY1) for i in range(1, 5)], "id long, date_time timestamp_ntz")
    source = spark.createDataFrame([(i, DAY2) for i in (4, 5, 6)], "id long, date_time timestamp_ntz")
    spec = PartitionSpec("date_time", "datetime", "day")
    golden = [(i, DAY1) for i in (1, 2, 3)] + [(i, DAY2) for i in (4, 5, 6)]
    assert rows(merge(target, source, "id", partition=spec, partition_scope="all")) == golden
    pruned = rows(merge(target, source, "id", partition=spec))
    assert len(pruned) == 7 and (4, DAY1) in pruned and (4, DAY2) in pruned


def test_source_without_dates_matches_nothing(spark):
    spec = PartitionSpec("date_time", "datetime", "day")
    target = spark.createDataFrame([(1, DAY1)], "id long, date_time timestamp_ntz")
    source = spark.createDataFrame([(1, None)], "id long, date_time timestamp_ntz")
    assert merge(target, source, "id", partition=spec).count() == 2


def test_special_column_names(spark, rows):
    target = spark.sql("SELECT 1 AS id, 'x' AS `select`, 2L AS `field-with-dash`, 'p' AS `source`, 'q' AS `dest`")
    source = spark.sql("SELECT 1 AS id, 'y' AS `select`, 3L AS `field-with-dash`, 'r' AS `source`, 's' AS `dest`")
    assert rows(merge(target, source, "id", skip_unchanged=True)) == [(1, "y", 3, "r", "s")]


def model(target, source, skip):
    """The rules of a keyed merge over plain tuples (key, value)."""
    by_key = {}
    for key, value in source:
        by_key.setdefault(key, []).append(value)
    out, matched = [], set()
    for key, value in target:
        if key is not None and key in by_key:
            if len(by_key[key]) > 1:
                return None
            matched.add(key)
            out.append((key, by_key[key][0]))
        else:
            out.append((key, value))
    return out + [(k, v) for k, v in source if k is None or k not in matched]


@pytest.mark.parametrize("seed", range(6))
def test_random_merges_follow_the_model(spark, seed):
    rng = random.Random(seed)

    def some(n, repeat):
        keys = [rng.choice([None, *range(40)]) for _ in range(n)] if repeat else rng.sample(range(40), n) + [None]
        return [(k, rng.randrange(5)) for k in keys]

    target, source = some(30, True), some(12, seed % 3 == 0)
    df = merge(
        spark.createDataFrame(target, "k long, v long"),
        spark.createDataFrame(source, "k long, v long"),
        "k",
        skip_unchanged=seed % 2 == 0,
    )
    expected = model(target, source, False)
    if expected is None:
        with pytest.raises(Exception, match="more than one source row"):
            df.collect()
    else:
        order = lambda r: (r[0] is not None, str(r))
        assert sorted(map(tuple, df.collect()), key=order) == sorted(expected, key=order)


def test_a_small_source_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(100_000).selectExpr("id", "id * 2 AS v", "cast(id as string) AS wide").write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    plan = merge(target, target.where("id < 10"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan


def test_a_hot_key_goes_through(spark):
    """A third of the target and many unmatched source rows share one key."""
    target = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    source = spark.range(9_000).selectExpr("if(id < 3000, -1, id + 25000) AS k", "-id AS v").unionByName(
        spark.sql("SELECT 0L AS k, -1L AS v")
    )
    from tidemark.session import setting

    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        done = merge(target, source, "k")
        assert done.where("k = 0").select("v").distinct().collect()[0][0] == -1
        assert done.where("k = -1").count() == 3_000


def test_two_sided_predicate_over_repeated_keys(spark, rows):
    target = spark.createDataFrame([(1, 10), (2, 10), (3, 10)], "id int, v int")
    source = [(1, 5), (1, 20), (2, 5), (2, 6), (4, 1), (4, 2)]
    for order in (source, source[::-1]):
        df = spark.createDataFrame(order, "id int, v int")
        got = rows(merge(target, df, "id", predicates=["source.v > dest.v"]))
        assert got == sorted([(1, 20), (1, 5), (2, 10), (2, 5), (2, 6), (3, 10), (4, 1), (4, 2)], key=lambda r: [(True, str(v)) for v in r])
    both = spark.createDataFrame([(1, 20), (1, 30)], "id int, v int")
    with pytest.raises(Exception, match="more than one source row"):
        merge(target, both, "id", predicates=["source.v > dest.v"]).collect()


def test_plan_shuffles_no_wide_aggregate(spark):
    target = spark.range(100).selectExpr("id", "id AS v", "id AS w")
    source = spark.range(50).selectExpr("id", "id + 1 AS v", "id AS w")
    plan = merge(target, source, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
