from datetime import datetime, timezone

from conftest import rows_of
from pyspark.sql import functions as F

from topictally.functions import split_words
from topictally.operators import (
    count_by_key,
    flat_map_values,
    flatten_window,
    keep,
    map_values,
    regroup,
    rekey,
    windowed_count,
)


def topic(spark, rows):
    return spark.createDataFrame(rows, "key bigint, value string")


def test_rekey_by_value_and_expression(spark):
    df = topic(spark, [(1, "a"), (2, "b")])
    assert rows_of(rekey(df), "key", "value") == [("a", "a"), ("b", "b")]
    assert rows_of(rekey(df, F.upper("value")), "key") == [("A",), ("B",)]
    assert rows_of(rekey(df, lambda v: F.concat(v, v)), "key") == [("aa",), ("bb",)]


def test_rekey_by_whole_record(spark):
    df = spark.createDataFrame([(b"k", "p", "x"), (b"j", "p", "x"), (b"k", "q", None)], "key binary, page string, flags string")
    counts = count_by_key(rekey(df, all_columns=True)).select("key.*", "count")
    assert rows_of(counts, "page", "flags", "count") == [("p", "x", 2), ("q", None, 1)]
    some = count_by_key(rekey(df, all_columns=["page"])).select("key.*", "count")
    assert rows_of(some, "page", "count") == [("p", 2), ("q", 1)]


def test_keep_leaves_out_null_predicates(spark):
    df = topic(spark, [(1, "a"), (2, None)])
    assert rows_of(keep(df, lambda v: v != "z"), "key") == [(1,)]


def test_map_values_keeps_the_key(spark):
    df = topic(spark, [(1, "a")])
    assert rows_of(map_values(df, F.length), "key", "value") == [(1, 1)]


def test_flat_map_values_keeps_the_key(spark):
    df = topic(spark, [(1, "a b"), (2, ""), (3, "  "), (4, None)])
    got = rows_of(flat_map_values(df, split_words), "key", "value")
    assert got == [(1, "a"), (1, "b"), (2, "")]


def test_flatten_window_and_regroup(spark):
    at = datetime(2024, 1, 1, 0, 0, 30, tzinfo=timezone.utc)
    df = spark.createDataFrame([("p", "i", at), ("q", "i", at), ("q", "i", at)], "page string, industry string, timestamp timestamp")
    counts = windowed_count(df, ["page", "industry"])
    start = 1_704_067_200_000
    flat = flatten_window(counts)
    assert rows_of(flat, "windowStart", "page", "count") == [(start, "p", 1), (start, "q", 2)]
    grouped = regroup(counts, "industry", {"page": "page", "n": "count", "unit": F.lit("views")})
    assert grouped.columns == ["window", "industry", "page", "n", "unit"]
    assert regroup(counts, ["industry"]).columns == ["window", "industry", "page", "count"]
    totals = grouped.groupBy("window", "industry").agg(F.sum("n").alias("n"))
    assert rows_of(totals, "industry", "n") == [("i", 3)]
