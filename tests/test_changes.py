import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from conftest import rows_of

from topictally.operators import changelog
from topictally.operators.changes import block_bounds, block_number

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def running(records):
    """(place, key) pairs as (place, key, count so far)."""
    seen = Counter()
    result = []
    for place, key in sorted(records, key=lambda r: r[0]):
        seen[key] += 1
        result.append((place, key, seen[key]))
    return sorted(result, key=repr)


@pytest.mark.parametrize("blocks", [1, 3, 50, 1000])
def test_hot_key_is_numbered_over_blocks(spark, blocks):
    random.seed(blocks)
    records = [(i, "hot" if random.random() < 0.6 else random.choice("abc")) for i in range(400)]
    shuffled = random.sample(records, len(records))
    df = spark.createDataFrame(shuffled, "offset bigint, key string").repartition(5)
    got = rows_of(changelog(df, blocks=blocks), "offset", "key", "count")
    assert got == running(records)


def test_blocks_bound_the_group_sizes(spark):
    df = spark.range(1000).selectExpr("id AS offset", "'hot' AS key")
    plan = changelog(df, blocks=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [row_number()" in plan and "_block" in plan


def test_several_partitions_and_sparse_or_negative_offsets(spark):
    records = [(o, p) for o in (-7, -1, 0, 1, 5, 10_000_000_000_000_001) for p in (0, 1)]
    df = spark.createDataFrame([(o, p, "k") for o, p in records], "offset bigint, partition int, key string")
    got = changelog(df, order=["offset", "partition"], blocks=4)
    ordered = sorted(got.collect(), key=lambda r: (r.offset, r.partition))
    assert [r["count"] for r in ordered] == list(range(1, len(records) + 1))


def test_windowed(spark):
    records = [(i, "a" if i % 3 else "b", START + timedelta(seconds=17 * i)) for i in range(60)]
    df = spark.createDataFrame(records, "offset bigint, key string, timestamp timestamp")
    got = changelog(df, size="1 minute", blocks=2).selectExpr(
        "offset", "unix_millis(window.start) AS start", "key", "count"
    )
    keyed = [(i, (int(t.timestamp()) // 60 * 60_000, k)) for i, k, t in records]
    expected = sorted(((i, s, k, n) for i, (s, k), n in running(keyed)), key=repr)
    assert rows_of(got, "offset", "start", "key", "count") == expected


def test_null_and_record_keys(spark):
    rows = [(0, None, 1), (1, "x", None), (2, None, 1), (3, "x", None)]
    df = spark.createDataFrame(rows, "offset bigint, key string, other int")
    assert rows_of(changelog(df), "offset", "count") == [(1, 1), (3, 2)]
    kept = changelog(df, keep_null_key=True)
    assert rows_of(kept, "offset", "count") == [(0, 1), (1, 1), (2, 2), (3, 2)]
    record = changelog(df, key=["key", "other"], blocks=1)
    assert rows_of(record, "offset", "count") == [(0, 1), (1, 1), (2, 2), (3, 2)]


def test_a_record_without_a_place_fails(spark):
    df = spark.createDataFrame([(0, "a"), (None, "a")], "offset bigint, key string")
    with pytest.raises(Exception, match="offset is null"):
        changelog(df).collect()
    with pytest.raises(ValueError):
        changelog(df, blocks=0)


def test_carried_counts_are_added(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "offset bigint, key string")
    carried = spark.createDataFrame([("a", 10)], "key string, _carried bigint")
    got = rows_of(changelog(df, blocks=1, carried=carried), "offset", "count")
    assert got == [(0, 11), (1, 1), (2, 12)]


@pytest.mark.parametrize("outlier", [10**15, -(10**15)])
def test_an_outlier_leaves_blocks_even(spark, outlier):
    """One hot key, offsets that start at different places in two partitions, and a far offset."""
    df = spark.range(10_000).selectExpr("if(id % 2 = 0, id, id + 5000000) AS offset", "'hot' AS key")
    df = df.union(spark.createDataFrame([(outlier, "hot")], "offset bigint, key string"))
    rows = df.withColumn("_bounds", df.agg(block_bounds("offset", 20).alias("b")).scalar())
    sizes = [r[1] for r in rows.groupBy(block_number("offset", 20, F.col("_bounds"))).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert changelog(df, blocks=20).agg({"count": "max"}).first()[0] == 10_001
