"""The lookup join against a plain join, by each of its ways."""

import random

import pytest

from tagshelf.operators import lookup

WAYS = {"broadcast": {}, "shuffled": {"broadcast_bytes": -1},
        "salted": {"broadcast_bytes": -1, "hot_rows": 20}}


@pytest.fixture(scope="module")
def sides(spark):
    chance = random.Random(3)
    keys = ["hot"] * 100 + ["warm"] * 40 + [None] * 60 + [f"k{chance.randint(0, 60)}" for _ in range(100)]
    data = [(k, i if i % 7 else 0) for i, k in enumerate(keys)]
    data += [("hot", -1)] * 30  # full copies
    chance.shuffle(data)
    few = [("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 60, 2)] + [("unused", "u")]
    return (spark.createDataFrame(data, "key string, n int").repartition(6),
            spark.createDataFrame(few, "key string, v string"))


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("way", WAYS)
def test_lookup_join(shuffled_joins, sides, way):
    df, few = sides
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = lookup.lookup_join(df, few, "key", how, **WAYS[way])
        want = df.join(few, "key", how)
        assert got.columns == want.columns and ordered(got) == ordered(want)


@pytest.mark.parametrize("way", WAYS)
def test_small_join(shuffled_joins, sides, way):
    repeated, unique = sides
    got = lookup.small_join(unique, repeated, "key", **WAYS[way]).select("key", "n", "v")
    assert ordered(got) == ordered(repeated.join(unique, "key").select("key", "n", "v"))


def test_hot_keys(sides):
    found = {r.key: r._salts for r in lookup.hot_keys(sides[0], "key", 40).collect()}
    assert found == {"hot": 4, "warm": 1}


def portions(spark, df, few, hot_rows):
    """Rows of each key by the task that joins them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = lookup.lookup_join(df, few, "key", "left", broadcast_bytes=-1, hot_rows=hot_rows)
        counts = joined.selectExpr("key", "spark_partition_id() as task").groupBy("key", "task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    tasks = {}
    for row in counts:
        tasks.setdefault(row.key, []).append(row["count"])
    return tasks


def test_hot_rows_are_spread(spark, shuffled_joins, sides):
    """No task joins more than a few portions of a frequent key's rows, nor all without a key."""
    df, few = sides
    whole, spread = (portions(spark, df, few, n) for n in (1_000, 10))
    assert len(whole["hot"]) == len(whole["warm"]) == 1
    assert max(spread["hot"]) <= 50 and len(spread["hot"]) >= 4
    assert len(spread["warm"]) >= 2 and len(whole[None]) > 3


def test_more_hot_keys_than_a_thousand_are_all_spread(spark, shuffled_joins):
    df = spark.range(1_100 * 12).selectExpr("concat('k', id % 1100) as key", "id as n").repartition(6)
    few = spark.range(1_100).selectExpr("concat('k', id) as key", "id as v")
    tasks = portions(spark, df, few, 2)
    assert len(tasks) == 1_100 and all(sum(t) == 12 and len(t) > 1 for t in tasks.values())


@pytest.mark.parametrize("way", WAYS)
def test_an_empty_lookup_side(sides, way):
    df, few = sides
    for empty in (few.limit(0), few.filter("false"), few.filter("v = 'none'")):
        assert lookup.lookup_join(df, empty, "key", "left_anti", **WAYS[way]).count() == df.count()
        assert lookup.lookup_join(df, empty, "key", **WAYS[way]).count() == 0
