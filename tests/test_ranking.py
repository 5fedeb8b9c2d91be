import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from topictally.operators import last_n, top_n, top_n_text
from topictally.operators.ranking import _spread


def counts(spark, rows):
    return spark.createDataFrame(rows, "industry string, page string, n bigint")


TIES = [("i", "b", 5), ("i", "a", 5), ("i", "c", 9), ("i", "d", 1), ("j", "z", 1)]


def test_ties_go_by_item(spark):
    got = top_n(counts(spark, TIES), "industry", "n", 3, ties=["page"])
    expected = [("i", "a", 2), ("i", "b", 3), ("i", "c", 1), ("j", "z", 1)]
    assert rows_of(got, "industry", "page", "rank") == expected
    assert dict(got.dtypes)["rank"] == "bigint"


def test_lowest_first_and_own_ordering(spark):
    low = top_n(counts(spark, TIES), "industry", "n", 1, descending=False, ties=["page"])
    assert rows_of(low, "page") == [("d",), ("z",)]
    own = top_n(counts(spark, TIES), "industry", [F.length("page").asc(), F.col("page").desc()], 1)
    assert rows_of(own, "page") == [("d",), ("z",)]


def test_differences_beyond_32_bits(spark):
    rows = [("i", "a", 2**40), ("i", "b", 1), ("i", "c", 2**62)]
    got = top_n(counts(spark, rows), "industry", "n", 2)
    assert rows_of(got, "page", "rank") == [("a", 2), ("c", 1)]


def test_a_hundred_of_many(spark):
    random.seed(1)
    rows = [(random.choice("ij"), f"p{i}", random.randrange(50)) for i in range(900)]
    got = top_n(counts(spark, rows).repartition(6), "industry", "n", ties=["page"])
    for group in "ij":
        ranked = sorted((-n, p) for g, p, n in rows if g == group)[:100]
        assert rows_of(got.filter(F.col("industry") == group), "page") == sorted((p,) for _, p in ranked)


def test_more_than_the_group_limit_is_cut_before_the_shuffle(spark):
    rows = [("i", f"p{i:05d}", i % 97) for i in range(3000)]
    df = counts(spark, rows).repartition(7)
    got = top_n(df, "industry", "n", 1500, ties=["page"])
    ranked = sorted((-n, p) for _, p, n in rows)[:1500]
    assert rows_of(got, "page", "rank") == sorted((p, k) for k, (_, p) in enumerate(ranked, 1))
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_groups_are_cut_before_the_shuffle(spark):
    plan = top_n(counts(spark, TIES), "industry", "n", 3)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("WindowGroupLimit") == 2


def test_text_form(spark):
    got = top_n_text(counts(spark, TIES), "industry", "n", "page", 2, ties=["page"])
    assert rows_of(got, "industry", "value") == [("i", "c\na\n"), ("j", "z\n")]


def test_last_n(spark):
    df = spark.createDataFrame([(k, i) for k in "ab" for i in range(6)], "key string, offset bigint")
    got = last_n(df, "key", "offset", 2)
    assert rows_of(got, "key", "offset", "rank") == [("a", 4, 2), ("a", 5, 1), ("b", 4, 2), ("b", 5, 1)]


@pytest.mark.parametrize("n", [0, -1])
def test_n_below_one(spark, n):
    with pytest.raises(ValueError):
        top_n(counts(spark, TIES), "industry", "n", n)
    with pytest.raises(ValueError):
        last_n(counts(spark, TIES), "industry", "n", n)


@pytest.mark.parametrize("n", [3, 1500])
def test_a_hot_group_is_merged_as_a_tree(spark, n):
    """No task gets the rows of all tasks, and ranks are those of one sort."""
    rows = spark.range(0, 20_000, numPartitions=16).selectExpr("'hot' AS g", "id * 7919 % 20011 AS v", "id")
    rows = rows.unionByName(spark.range(50).selectExpr("'b' AS g", "id % 5 AS v", "id"))
    got = top_n(rows, "g", "v", n, ties=["id"], spread=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(g") == 2
    assert plan.count("WindowGroupLimit") == 4
    assert rows_of(got, "g", "v", "id", "rank") == rows_of(
        top_n(rows, "g", "v", n, ties=["id"], spread=1), "g", "v", "id", "rank"
    )


def test_the_tree_is_as_wide_as_the_square_root_of_the_tasks(spark):
    df, before = spark.range(1), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        assert _spread(df, 100) == 45
        assert _spread(df, 3) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_last_rows_of_one_place_go_by_ties(spark):
    rows = spark.createDataFrame([("k", 1, v) for v in (3, 1, 2)], "k string, o int, v int")
    got = last_n(rows, "k", "o", 2, ties=[F.col("v").desc()])
    assert rows_of(got, "v", "rank") == [(2, 2), (3, 1)]
