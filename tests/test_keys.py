"""One row per key, surrogates and lookups, also beyond what one task may hold."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import sorted_rows
from txnstar import assign_key, assign_key_in_ranges, hot_keys, in_ranges, lookup_key, one_per_key
from txnstar.sources.workdir import materialise


def test_one_per_key_takes_the_last(spark):
    rows = [
        ("k1", 1, "a", "x"),
        ("k1", 2, "b", None),
        ("k1", 2, "a", "z"),
        ("k2", None, "a", "y"),
        (None, 5, "a", "u"),
        (None, 4, "b", "v"),
    ]
    df = spark.createDataFrame(rows, "k string, t int, id string, attr string")
    out = one_per_key(df, ["k"], ["t", "id"], ["attr"])
    assert sorted_rows(out) == sorted([("k1", None), ("k2", "y"), (None, "u")], key=repr)


def test_one_per_key_breaks_ties_by_attributes(spark):
    rows = [("k", 1, "a", None), ("k", 1, "b", 2.0), ("k", 1, "b", 3.0), ("k", 1, None, 9.0)]
    df = spark.createDataFrame(rows, "k string, t int, a string, b double")
    assert one_per_key(df, ["k"], ["t"], ["a", "b"]).collect() == [("k", "b", 3.0)]


def test_one_per_key_whatever_the_partitioning(spark):
    rng = random.Random(7)
    rows = [
        # A third of the rows share one key.
        ("hot" if rng.random() < 0.33 else f"k{rng.randrange(40)}", rng.randrange(5), rng.random())
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    expected = {}
    for k, t, v in rows:
        expected[k] = max(expected.get(k, (t, v)), (t, v))
    expected = sorted([(k, v) for k, (_, v) in expected.items()], key=repr)
    for parts in (1, 5, 37):
        out = one_per_key(df.repartition(parts), ["k"], ["t"], ["v"])
        assert sorted_rows(out) == expected


def test_one_per_key_merges_before_the_shuffle(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    plan = one_per_key(df, ["k"], ["v"], ["v"])._jdf.queryExecution().toString()
    assert "partial_max" in plan


VALUES = [f"v{i:04d}" for i in range(500)] + [None]


def _numbered(df, col, name, ranged):
    if not ranged:
        return assign_key(df, col, name)
    return assign_key_in_ranges(materialise(in_ranges(df, col), "ranges"), col, name)


@pytest.mark.parametrize("merge", ["true", "false"])
@pytest.mark.parametrize("ranged", [False, True])
def test_dense_key(spark, conf, ranged, merge):
    # Unmerged, the eight shuffle partitions stay eight ranges.
    conf("spark.sql.adaptive.coalescePartitions.enabled", merge)
    shuffled = random.Random(3).sample(VALUES, len(VALUES))
    df = spark.createDataFrame([(v,) for v in shuffled], "value string").repartition(13)
    out = _numbered(df, "value", "value_id", ranged)
    assert out.columns == ["value", "value_id"]
    assert out.schema["value_id"].dataType.typeName() == "long"
    assert sorted_rows(out) == sorted(
        [(v, i + 1) for i, v in enumerate(VALUES)], key=repr
    )


@pytest.mark.parametrize("ranged", [False, True])
def test_dense_key_of_nothing(spark, ranged):
    df = spark.createDataFrame([], "value string")
    assert _numbered(df, "value", "value_id", ranged).count() == 0


def _jobs_started(spark, build):
    """Jobs that building a frame, without reading it, has started."""
    spark.sparkContext.setJobGroup("building", "building a frame")
    build()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return list(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))


def test_building_a_frame_runs_no_job(spark):
    facts, dim, _ = _lookup_case(spark)
    on = [("k", "name")]

    def build():
        assign_key(dim, "name", "key")
        assign_key_in_ranges(in_ranges(dim, "name"), "name", "key")
        lookup_key(facts, dim, on, "name_id")
        lookup_key(facts, dim, on, "name_id", small=False)

    assert _jobs_started(spark, build) == []


def test_hot_keys_are_few_and_never_null(spark):
    facts, _, _ = _lookup_case(spark)
    assert {"hot", "gone"} <= {r.k for r in hot_keys(facts, ["k"]).collect()}
    assert hot_keys(facts, ["k"]).filter("k IS NULL").count() == 0
    assert hot_keys(facts.filter("false"), ["k"]).count() == 0
    many = spark.range(5000).select(F.col("id").alias("k"))
    assert hot_keys(many, ["k"]).count() == 0


def _lookup_case(spark):
    rng = random.Random(11)
    facts = []
    for i in range(4000):
        draw = rng.random()
        key = "hot" if draw < 0.34 else None if draw < 0.6 else f"k{rng.randrange(900)}"
        facts.append((i, key))
    facts += [(-1, "hot")] * 50  # equal rows stay apart
    facts += [(-2, "gone")] * 60  # hot, and not in the dimension
    dim = [("hot", 0)] + [(f"k{i}", i + 1) for i in range(700)] + [(None, 99999)]
    ids = {k: v for k, v in dim if k is not None}
    expected = sorted([(i, k, ids.get(k)) for i, k in facts], key=repr)
    return (
        spark.createDataFrame(facts, "i int, k string").repartition(9),
        spark.createDataFrame(dim, "name string, name_id long"),
        expected,
    )


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("aqe", ["true", "false"])
def test_lookup(spark, conf, aqe, small):
    conf("spark.sql.adaptive.enabled", aqe)
    facts, dim, expected = _lookup_case(spark)
    out = lookup_key(facts, dim, [("k", "name")], "name_id", small=small)
    assert out.columns == ["i", "k", "name_id"]
    assert sorted_rows(out) == expected


def test_lookup_by_shuffle_without_automatic_broadcast(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts, dim, expected = _lookup_case(spark)
    out = lookup_key(facts, dim, [("k", "name")], "name_id", small=False)
    assert sorted_rows(out) == expected
    # Only the cold rows meet the dimension in a sort-merge join.
    plan = out._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in plan


def test_lookup_on_two_columns(spark):
    facts = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", None), (3, "b", "x")], "i int, p string, q string"
    )
    dim = spark.createDataFrame([("a", "x", 7), (None, "x", 8)], "p string, q string, id long")
    for small in (True, False):
        out = lookup_key(facts, dim, [("p", "p"), ("q", "q")], "id", small=small)
        assert sorted_rows(out) == [(1, "a", "x", 7), (2, "a", None, None), (3, "b", "x", None)]


def test_small_lookup_leaves_the_rows_in_place(spark):
    facts, dim, _ = _lookup_case(spark)
    plan = lookup_key(facts.select("i", "k"), dim, [("k", "name")], "name_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text
