import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows_of

from topictally.functions import start_millis
from topictally.operators import count_by_key, windowed_count

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
START_MS = 1_704_067_200_000


def at(**delta):
    return START + timedelta(**delta)


def test_null_keys(spark):
    df = spark.createDataFrame([(None,), ("a",), (None,)], "key string")
    assert rows_of(count_by_key(df), "key", "count") == [("a", 1)]
    assert rows_of(count_by_key(df, keep_null_key=True), "key", "count") == [("a", 1), (None, 2)]


def test_weight(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("b", 1)], "key string, n int")
    counted = count_by_key(df, weight="n", name="records")
    assert rows_of(counted, "key", "records") == [("a", 5), ("b", 1)]
    assert dict(counted.dtypes)["records"] == "bigint"


def test_record_on_a_window_edge_is_in_the_later_window(spark):
    times = [at(), at(milliseconds=59_999), at(minutes=1)]
    df = spark.createDataFrame([("a", t) for t in times], "key string, timestamp timestamp")
    got = windowed_count(df).select(start_millis().alias("s"), "count")
    assert rows_of(got, "s", "count") == [(START_MS, 2), (START_MS + 60_000, 1)]


@pytest.mark.parametrize("size,advance", [(60, 60), (120, 60), (360, 60), (240, 60), (90, 60), (100, 15)])
def test_hopping_windows_against_brute_force(spark, size, advance):
    random.seed(size)
    records = [(random.choice("ab"), random.randrange(3600)) for _ in range(300)]
    expected = Counter()
    for key, second in records:
        first = (second - size) // advance * advance + advance
        for start in range(first, second + 1, advance):
            expected[(START_MS + start * 1000, key)] += 1
    rows = [(k, at(seconds=s)) for k, s in records]
    df = spark.createDataFrame(rows, "key string, timestamp timestamp")
    got = windowed_count(df, size=size * 1000, advance=advance * 1000)
    got = got.select(start_millis().alias("start"), "key", "count")
    assert {(r.start, r.key): r["count"] for r in got.collect()} == expected


def test_window_arguments(spark):
    df = spark.createDataFrame([("a", at())], "key string, timestamp timestamp")
    for size, advance in ((1000, 2000), (1000, 0)):
        with pytest.raises(ValueError):
            windowed_count(df, size=size, advance=advance)


def test_record_key_may_have_null_fields(spark):
    df = spark.createDataFrame([("p", None, at()), ("p", None, at())], "page string, flags string, timestamp timestamp")
    got = windowed_count(df, ["page", "flags"], "1 hour")
    assert rows_of(got, "page", "flags", "count") == [("p", None, 2)]


def test_narrow_hopping_windows_need_one_shuffle(spark):
    rows = spark.range(1000).selectExpr("timestamp_seconds(id * 60) AS timestamp", "id % 3 AS key")
    plans = {
        size: windowed_count(rows, size=size, advance="1 hour")._jdf.queryExecution().executedPlan().toString()
        for size in ("2 hours", "1 day")
    }
    assert plans["2 hours"].count("Exchange hashpartitioning") == 1
    assert plans["1 day"].count("Exchange hashpartitioning") == 2
