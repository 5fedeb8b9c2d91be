"""The five jobs from topic to topic, batch and stream."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from topictally.plans import jobs
from topictally.sources import TopicSettings, read_topic, write_topic
from topictally.streaming import Job

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
START_MS = 1_704_067_200_000
TEXTS = ["A b a", "", "  ", "b  c ", None]
WORDS = {"a": 2, "b": 2, "": 2, "c": 1}


@pytest.fixture
def places(spark, tmp_path):
    """Source as bytes, sink typed, and a job."""
    source = TopicSettings(root=str(tmp_path / "in"), encoded=True)
    sink = TopicSettings(root=str(tmp_path / "out"))
    return source, sink, Job(spark, tmp_path.name, str(tmp_path / "checkpoint"))


def run_args(streaming):
    return {"streaming": True, "available_now": True} if streaming else {"streaming": False}


def newest_counts(spark, sink, topic, streaming):
    path = sink.path(topic)
    table = spark.read.parquet(path)
    if streaming:
        table = table.groupBy("key").agg(F.max_by("value", "batch").alias("value"))
    return {r.key: r.value for r in table.collect()}


@pytest.mark.parametrize("streaming", [False, True])
@pytest.mark.parametrize("print_updates", [False, True])
def test_word_count(spark, places, streaming, print_updates, tmp_path):
    source, sink, job = places
    rows = [(str(i), (t,)) for i, t in enumerate(TEXTS)]
    messages = spark.createDataFrame(rows, "key string, value struct<message: string>")
    write_topic(messages.repartition(2), jobs.MESSAGES_TOPIC, source)
    place = str(tmp_path / "printed")

    def show(text):
        with open(place, "a") as file:
            file.write(text + "\n")

    updates = show if print_updates else False
    jobs.run_word_count(spark, source, sink, job, print_updates=updates, **run_args(streaming))
    assert newest_counts(spark, sink, jobs.WORD_COUNTS_TOPIC, streaming) == WORDS
    printed = Path(place).read_text().splitlines() if print_updates else []
    assert len(printed) == (len(WORDS) if print_updates else 0)
    assert ('{"key":"c","count":1}' in printed) == print_updates


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_word_count_does_not_depend_on_the_input_order(spark, parts):
    rows = [("k", (t,)) for t in TEXTS * 5]
    random.seed(parts)
    random.shuffle(rows)
    messages = spark.createDataFrame(rows, "key string, value struct<message: string>")
    counts = jobs.word_count(messages.repartition(parts))
    assert {r.key: r["count"] for r in counts.collect()} == {w: 5 * n for w, n in WORDS.items()}


def region_topic(spark, source):
    rows = [(i, r, i, START + timedelta(seconds=25 * i)) for i, r in enumerate("aabacab")]
    df = spark.createDataFrame(rows, "key bigint, value string, offset bigint, timestamp timestamp")
    write_topic(df.withColumn("partition", F.lit(0)).coalesce(1), jobs.REGIONS_TOPIC, source)
    return [(r, t) for _, r, _, t in rows]


@pytest.mark.parametrize("streaming", [False, True])
def test_region_count(spark, places, streaming):
    source, sink, job = places
    region_topic(spark, source)
    jobs.run_region_count(spark, source, sink, job, **run_args(streaming))
    expected = {"a": 4, "b": 2, "c": 1}
    assert newest_counts(spark, sink, jobs.REGION_COUNTS_TOPIC, streaming) == expected


def changes_of(records):
    seen = Counter()
    for region, at in records:
        start = START_MS + (at - START) // timedelta(minutes=1) * 60_000
        seen[(start, region)] += 1
        yield start, region, seen[(start, region)]


@pytest.mark.parametrize("kind", ["batch", "per_record", "per_batch"])
def test_windowed_region_count(spark, places, kind):
    source, sink, job = places
    changes = list(changes_of(region_topic(spark, source)))
    arguments = run_args(kind != "batch") | {"per_record": kind == "per_record"}
    jobs.run_windowed_region_count(spark, source, sink, job, **arguments)
    out = spark.read.parquet(sink.path(jobs.WINDOWED_COUNTS_TOPIC)).collect()
    got = []
    for row in out:
        key, value = json.loads(row.key), json.loads(row.value)
        assert list(key) == ["windowStart", "region"] and list(value) == ["count", "region"]
        assert key["region"] == value["region"]
        got.append((key["windowStart"], key["region"], value["count"]))
    if kind == "per_batch":
        changes = [(s, r, n) for (s, r), n in {(s, r): n for s, r, n in changes}.items()]
    assert sorted(got) == sorted(changes)


def view_topic(spark, source):
    views = [("p1", "x")] * 3 + [("p2", "x")] * 5 + [("p3", "y")] + [("p4", "x")] * 5
    rows = [(p, i, "X-ART", START + timedelta(minutes=n)) for n, (p, i) in enumerate(views)]
    rows += [("ad", "x", "AD", START)] * 9 + [("p9", "x", "ART", START + timedelta(days=3))]
    df = spark.createDataFrame(rows, "page string, industry string, flags string, timestamp timestamp")
    record = F.struct("page", "industry", "flags").alias("value")
    df = df.select(F.lit(None).cast("binary").alias("key"), record, "timestamp")
    write_topic(df.coalesce(1), jobs.PAGE_VIEWS_TOPIC, source)


HOUR = 3_600_000
FIRST_TEXTS = {(START_MS, "x"): "p2\np4\n", (START_MS, "y"): "p3\n"}
LAST_TEXT = {(START_MS + 72 * HOUR, "x"): "p9\n"}


@pytest.mark.parametrize("kind", ["batch", "final", "update"])
def test_top_pages(spark, places, kind):
    source, sink, job = places
    view_topic(spark, source)
    arguments = run_args(kind != "batch") | ({"emit": kind} if kind != "batch" else {})
    jobs.run_top_pages(spark, source, sink, job, n=2, **arguments)
    out = read_topic(spark, jobs.TOP_PAGES_TOPIC, sink, "string", "string").collect()
    got = {}
    for row in out:
        key = json.loads(row.key)
        assert key["windowEnd"] - key["windowStart"] == HOUR
        got[(key["windowStart"], key["key"])] = row.value
    # A stream gives final texts of closed windows only; the last one is still open.
    assert got == (FIRST_TEXTS if kind == "final" else FIRST_TEXTS | LAST_TEXT)


def test_avro_views_need_the_package(spark, places):
    source, sink, job = places
    view_topic(spark, source)
    with pytest.raises(RuntimeError, match="spark-avro"):
        jobs.run_top_pages(spark, source, sink, job, streaming=False, avro_schema='"string"')


def test_least_viewed_first(spark, places):
    source, sink, job = places
    view_topic(spark, source)
    jobs.run_top_pages(spark, source, sink, job, n=2, descending=False, streaming=False)
    out = read_topic(spark, jobs.TOP_PAGES_TOPIC, sink, "string", "string")
    assert ("p1\np2\n",) in rows_of(out, "value")


def test_hourly_article_views(spark):
    rows = [("p", "x", "ART", START), ("p", "x", "ART", START + timedelta(minutes=59))]
    rows += [("p", "x", "ART-2", START), ("p", "x", None, START), ("p", "x", "ART", START + timedelta(hours=1))]
    views = spark.createDataFrame(rows, "page string, industry string, flags string, timestamp timestamp")
    counts = jobs.hourly_article_views(views).selectExpr("unix_millis(window.start) AS s", "flags", "count")
    expected = [(START_MS, "ART", 2), (START_MS, "ART-2", 1), (START_MS + HOUR, "ART", 1)]
    assert rows_of(counts, "s", "flags", "count") == expected


def test_a_page_with_two_flags_is_one_item_of_the_list(spark):
    """JOB-4 counts whole records, JOB-5 ranks pages by all their views."""
    rows = [("p", "x", flags, START) for flags in ("ART", "ART", "ART,NEW", "AD")] + [("q", "x", "ART", START)]
    views = spark.createDataFrame(rows, "page string, industry string, flags string, timestamp timestamp")
    records = jobs.hourly_article_views(views)
    assert rows_of(records, "page", "flags", "count") == [("p", "ART", 2), ("p", "ART,NEW", 1), ("q", "ART", 1)]
    assert rows_of(jobs.top_pages(views), "page", "n", "rank") == [("p", 3, 1), ("q", 1, 2)]
