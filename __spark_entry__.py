
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from topictally.functions.windows import instant
from topictally.functions import is_article, lines, lower_words, split_words, start_millis
from topictally.operators import (
    changelog,
    count_by_key,
    flat_map_values,
    flatten_window,
    fold,
    keep,
    last_n,
    map_values,
    newest,
    regroup,
    rekey,
    top_n,
    windowed_count,
)
from topictally.plans import jobs
from topictally.plans.folds import ITEM_TOTALS, ItemProduct, ViewDivisor
from topictally.plans.standins import (
    EVENTS,
    SLICES,
    chat_messages,
    events_stream,
    order_regions,
    page_views,
    region_records,
    table,
    time_slices,
)
from topictally.session import Folder, scratch_folder
from topictally.sources import (
    TopicSettings,
    batch_writer,
    decode_json,
    encode_window_key,
    read_table,
    read_topic,
    write_topic,
)
from topictally.streaming import (
    Job,
    fold_stream,
    last_n_stream,
    latest,
    stream_changelog,
    top_n_stream,
    updating_aggregate,
)

try:
    from topictally.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("topictally.llm", "corpus_pipeline"):
        raise
    llm_queries = None


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_records(_events(spark, sf_dir))


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_views(_events(spark, sf_dir))


def _window_to_millis(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(start_millis().alias("window_start"), *columns)


# Counting


def word_count(spark, sf_dir):
    return jobs.word_count(chat_messages(table(spark, sf_dir, "conversations")))


def document_words(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("key"),
        F.struct(F.col("text").alias("message")).alias("value"),
    )
    return jobs.word_count(documents)


def message_sizes(spark, sf_dir):
    """Words per message: the split rule on its own, case kept."""
    words = flat_map_values(table(spark, sf_dir, "conversations"), split_words("text"))
    return count_by_key(words, ["conv_id", "turn"], name="words")


def region_count(spark, sf_dir):
    return jobs.region_count(order_regions(spark, sf_dir), weight="records")


def event_type_count(spark, sf_dir):
    return jobs.region_count(_regions(spark, sf_dir))


def region_count_windowed(spark, sf_dir):
    return jobs.windowed_region_count(_regions(spark, sf_dir))


def region_count_hopping(spark, sf_dir):
    return jobs.windowed_region_count(_regions(spark, sf_dir), "2 hours", "1 hour")


def region_count_hopping_wide(spark, sf_dir):
    """A day in steps of one hour: counted per hour first, then copied to 24 windows."""
    return jobs.windowed_region_count(_regions(spark, sf_dir), "1 day", "1 hour")


def hourly_article_views(spark, sf_dir):
    counts = jobs.hourly_article_views(_views(spark, sf_dir))
    return _window_to_millis(counts, "page", "industry", "flags", "count")


def record_count(spark, sf_dir):
    """The whole record as the key."""
    views = _views(spark, sf_dir).drop("timestamp")
    return count_by_key(rekey(views, all_columns=True)).select("key.*", "count")


def article_views(spark, sf_dir):
    """The filter on its own."""
    return keep(_views(spark, sf_dir), is_article()).select(
        F.unix_micros("timestamp").alias("time"), "page", "industry", "flags"
    )


# Change streams


def region_changelog(spark, sf_dir):
    changes = changelog(rekey(_regions(spark, sf_dir)))
    return changes.select("offset", "key", "count")


def windowed_changelog(spark, sf_dir):
    changes = changelog(rekey(_regions(spark, sf_dir)), size="1 day")
    return _window_to_millis(changes, "offset", "key", "count")


# Ranking


def top_pages(spark, sf_dir):
    ranked = jobs.top_pages(_views(spark, sf_dir), 3, "1 day")
    return _window_to_millis(ranked, "industry", "page", "n", "rank")


def bottom_pages(spark, sf_dir):
    ranked = jobs.top_pages(_views(spark, sf_dir), 3, "1 day", descending=False)
    return _window_to_millis(ranked, "industry", "page", "n", "rank")


def top_pages_text(spark, sf_dir):
    texts = jobs.top_pages_text(_views(spark, sf_dir), 3, "1 day")
    return _window_to_millis(texts, "industry", "value")


def top_pages_hourly(spark, sf_dir):
    """The job with its own settings: windows of one hour, 100 pages."""
    texts = jobs.top_pages_text(_views(spark, sf_dir))
    return _window_to_millis(texts, "industry", "value")


def top_words(spark, sf_dir):
    """Ranking over an unwindowed table: most used words per role."""
    messages = table(spark, sf_dir, "conversations").select("role", F.col("text").alias("value"))
    words = flat_map_values(messages, lower_words("value"))
    counts = count_by_key(words, ["role", "value"], name="n")
    return top_n(counts, "role", "n", 1500, ties=["value"])


def last_events(spark, sf_dir):
    rows = _events(spark, sf_dir).select("user_id", "event_id", "event_type", "value")
    return last_n(rows, "user_id", "event_id", 5)


def regroup_aggregate(spark, sf_dir):
    """A table of counts regrouped by industry and aggregated again."""
    views = keep(_views(spark, sf_dir), is_article())
    counts = windowed_count(views, ["page", "industry"], "1 day")
    stats = regroup(counts, "industry", {"page": "page", "n": "count", "unit": F.lit("views")})
    groups = stats.groupBy("window", "industry", "unit")
    totals = groups.agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("views"))
    return _window_to_millis(totals, "industry", "unit", "pages", "views")


def fold_pages(spark, sf_dir):
    """The same regrouping with an aggregate that Spark lacks."""
    counts = flatten_window(jobs.page_counts(_views(spark, sf_dir), "1 day"), "window_start")
    return fold(counts, ["window_start", "industry"], ViewDivisor())


def page_spread(spark, sf_dir):
    """The same regrouping with several built-in aggregates."""
    counts = flatten_window(jobs.page_counts(_views(spark, sf_dir), "1 day"), "window_start")
    views = F.sum("n").alias("views"), F.max("n").alias("most")
    return counts.groupBy("window_start", "industry").agg(F.count(F.lit(1)).alias("pages"), *views)


# Topics


def json_decode(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", F.col("props").alias("value"))
    decoded = decode_json(rows, "k bigint", on_error="drop")
    return decoded.select("event_id", F.col("value.k").alias("k"))


def region_json_topic(spark, sf_dir):
    return jobs.region_messages(jobs.windowed_region_count(_regions(spark, sf_dir)))


def top_pages_topic(spark, sf_dir):
    """Window and industry as JSON key, the ranked pages as text value."""
    return encode_window_key(jobs.top_pages_text(_views(spark, sf_dir), 3, "1 day"), "industry")


def region_lines(spark, sf_dir):
    """Value transformation and line form: each region name once per line."""
    regions = count_by_key(rekey(_regions(spark, sf_dir)))
    values = map_values(regions.withColumn("value", F.col("key")), F.upper)
    return values.select("key", lines(F.array("key", "value")).alias("value"))


def _scratch(spark: SparkSession, name: str, **settings) -> TopicSettings:
    return TopicSettings(root=scratch_folder(spark, name), **settings)


def _job(spark: SparkSession, settings: TopicSettings, name: str) -> Job:
    unique = settings.root.rsplit("-", 1)[-1]
    cores = spark.sparkContext.defaultParallelism
    return Job(spark, f"{name}-{unique}", f"{settings.root}/checkpoint", partitions=cores)


def topic_round_trip(spark, sf_dir):
    """Region records written to a topic as bytes, read back typed, and counted."""
    settings = _scratch(spark, "round-trip", encoded=True)
    write_topic(_regions(spark, sf_dir), jobs.REGIONS_TOPIC, settings, mode="overwrite")
    records = read_topic(spark, jobs.REGIONS_TOPIC, settings, "bigint", "string")
    counts = windowed_count(rekey(records), size="1 hour")
    return _window_to_millis(counts, "key", "count")


def word_count_job(spark, sf_dir):
    """The whole job, from a topic of JSON messages to a topic of counts."""
    settings = _scratch(spark, "word-count", encoded=True)
    messages = chat_messages(table(spark, sf_dir, "conversations"))
    write_topic(messages, jobs.MESSAGES_TOPIC, settings, mode="overwrite")
    sink = TopicSettings(root=settings.root)
    jobs.run_word_count(spark, settings, sink, _job(spark, settings, "words"), streaming=False)
    return read_topic(spark, jobs.WORD_COUNTS_TOPIC, sink, "string", "bigint").select(
        "key", F.col("value").alias("count")
    )


def printed_counts(spark, sf_dir):
    """The word count job with its rows printed where they lie, here into a file for each task."""
    settings = _scratch(spark, "printed", encoded=True)
    messages = chat_messages(table(spark, sf_dir, "conversations"))
    write_topic(messages, jobs.MESSAGES_TOPIC, settings, mode="overwrite")
    sink = TopicSettings(root=settings.root)
    folder = f"{settings.root}/lines".removeprefix("file:")
    os.makedirs(folder)

    def show(line: str) -> None:
        task = TaskContext.get()
        with open(f"{folder}/{task.partitionId()}-{task.attemptNumber()}.txt", "a") as file:
            file.write(line + "\n")

    job = _job(spark, settings, "printed")
    jobs.run_word_count(spark, settings, sink, job, streaming=False, print_updates=show)
    printed = spark.read.schema("value string").text(f"{settings.root}/lines")
    return decode_json(printed, "key string, count bigint", on_error="fail").select("value.*")


# Streams


def _run(spark, name, writer_of) -> DataFrame:
    """Run a stream over all present input and give back what its sink wrote."""
    settings = _scratch(spark, name)
    job = _job(spark, settings, name)
    writer = writer_of(batch_writer("out", settings, key=None), job)
    job.run(writer, available_now=True)
    return spark.read.parquet(settings.path("out"))


def _newest_batch(df: DataFrame) -> DataFrame:
    newest = df.agg(F.max("batch").alias("batch"))
    return df.join(newest, "batch").drop("batch")


def stream_region_count(spark, sf_dir):
    counts = jobs.region_count(region_records(events_stream(spark, sf_dir)))
    out = _run(
        spark,
        "region-count",
        lambda sink, job: counts.writeStream.outputMode("complete").foreachBatch(sink),
    )
    return _newest_batch(out)


def _run_in_slices(spark, sf_dir, name, writer_of, late=False, settings=None) -> DataFrame:
    """Like ``_run``, but the events arrive in parts, and the job is stopped and started between."""
    settings = settings or _scratch(spark, name)
    job = _job(spark, settings, name)
    files = Folder(spark, settings.root)
    for part in time_slices(table(spark, sf_dir, "events"), f"{settings.root}/parts", late):
        files.move(f"parts/{part}", f"arrived/{part}")
        events = spark.readStream.schema(EVENTS).parquet(f"{settings.root}/arrived/*")
        sink = batch_writer("out", settings, key=None)
        job.run(writer_of(events, sink, job), available_now=True)
    return spark.read.parquet(settings.path("out"))


def _updates(counts: DataFrame, sink) -> DataStreamWriter:
    return counts.writeStream.outputMode("update").foreachBatch(sink)


def stream_region_updates(spark, sf_dir):
    """Update mode: each key's last update is its count."""
    out = _run_in_slices(
        spark,
        sf_dir,
        "region-updates",
        lambda events, sink, job: _updates(jobs.region_count(region_records(events)), sink),
    )
    return newest(out, "key", "count")


def stream_region_state(spark, sf_dir):
    """The counts as the job holds them after its last part, read from its named state."""
    settings = _scratch(spark, "region-state")
    jobs_of = []

    def writer_of(events, sink, job):
        jobs_of.append(job)
        return _updates(jobs.region_count(region_records(events)), sink)

    _run_in_slices(spark, sf_dir, "region-state", writer_of, settings=settings)
    return jobs_of[-1].state().select("key.key", "value.count")


def _windowed_updates(spark, sf_dir, late=False, **settings) -> DataFrame:
    out = _run_in_slices(
        spark,
        sf_dir,
        "windowed-updates",
        lambda events, sink, job: _updates(
            windowed_count(rekey(region_records(events)), **settings), sink
        ),
        late,
    )
    return _window_to_millis(newest(out, ["window", "key"], "count"), "key", "count")


def stream_windowed_updates(spark, sf_dir):
    """Every window, closed or not."""
    return _windowed_updates(spark, sf_dir)


def stream_hopping_updates(spark, sf_dir):
    return _windowed_updates(spark, sf_dir, size="2 hours", advance="1 hour")


def stream_late_records(spark, sf_dir):
    """Records late by less than the delay are counted, later ones are not."""
    micros = F.unix_micros(instant(table(spark, sf_dir, "events"), "ts"))
    first, last = table(spark, sf_dir, "events").agg(F.min(micros), F.max(micros)).first()
    delay = 0 if first is None else (last - first) * 11 // (5 * SLICES * 1000)
    return _windowed_updates(spark, sf_dir, late=True, size="1 hour", delay=delay)


def stream_windowed_count(spark, sf_dir):
    counts = windowed_count(rekey(region_records(events_stream(spark, sf_dir))))
    out = _run(spark, "windowed", lambda sink, job: counts.writeStream.foreachBatch(sink))
    return _window_to_millis(out, "key", "count")


def stream_hopping_count(spark, sf_dir):
    regions = rekey(region_records(events_stream(spark, sf_dir)))
    counts = windowed_count(regions, size="2 hours", advance="1 hour")
    out = _run(spark, "hopping", lambda sink, job: counts.writeStream.foreachBatch(sink))
    return _window_to_millis(out, "key", "count")


def stream_changes(spark, sf_dir):
    out = _run_in_slices(
        spark,
        sf_dir,
        "changes",
        lambda events, sink, job: stream_changelog(
            rekey(region_records(events)), sink, job.state_dir
        ),
    )
    return out.select("offset", "key", "count")


def stream_windowed_changes(spark, sf_dir):
    out = _run_in_slices(
        spark,
        sf_dir,
        "windowed-changes",
        lambda events, sink, job: stream_changelog(
            rekey(region_records(events)), sink, job.state_dir, size="1 day"
        ),
    )
    return _window_to_millis(out, "offset", "key", "count")


def _articles(events):
    return keep(page_views(events), is_article())


def stream_top_pages(spark, sf_dir):
    """Each window once, after it closed."""
    views = _articles(events_stream(spark, sf_dir))
    out = _run(
        spark,
        "top-pages",
        lambda sink, job: top_n_stream(views, "industry", "page", sink, 3, "1 day"),
    )
    return _window_to_millis(out, "industry", "page", F.col("count").alias("n"), "rank")


def _live_pages(spark, sf_dir, descending, views_of=_articles):
    out = _run_in_slices(
        spark,
        sf_dir,
        "live-pages",
        lambda events, sink, job: top_n_stream(
            views_of(events),
            "industry",
            "page",
            sink,
            3,
            "1 day",
            descending=descending,
            emit="update",
            state_dir=job.state_dir,
        ),
    )
    ranked = latest(out, ["window_start_ms", "industry"], "top")
    return ranked.select(
        F.col("window_start_ms").alias("window_start"),
        "industry",
        F.col("item").alias("page"),
        F.col("count").alias("n"),
        "rank",
    )


def stream_top_pages_live(spark, sf_dir):
    return _live_pages(spark, sf_dir, True)


def stream_bottom_pages_live(spark, sf_dir):
    return _live_pages(spark, sf_dir, False)


def _page_table(spark, sf_dir, aggregate) -> DataFrame:
    """The newest result per industry over the updating table of page counts."""
    out = _run_in_slices(
        spark,
        sf_dir,
        "table-fold",
        lambda events, sink, job: updating_aggregate(
            _articles(events), "industry", "page", aggregate, sink, job.state_dir
        ),
    )
    fields = [c for c in out.columns if c not in ("industry", "version", "batch")]
    newest = F.max_by(F.struct(*fields), "version").alias("newest")
    return out.groupBy("industry").agg(newest).select("industry", "newest.*")


def stream_table_fold(spark, sf_dir):
    """Pages and views per industry over the updating table of counts.

    A page's count changes from part to part, so its old row is removed and a new one added.
    """
    return _page_table(spark, sf_dir, ITEM_TOTALS)


def stream_table_product(spark, sf_dir):
    """The same with an aggregate that Spark lacks: the product of all counts modulo a prime."""
    return _page_table(spark, sf_dir, ItemProduct())


def stream_fold(spark, sf_dir):
    """A fold over the records of a stream: each user's events and the divisor of their scores."""
    score = F.get_json_object("props", "$.k").cast("bigint").alias("n")
    out = _run_in_slices(
        spark,
        sf_dir,
        "fold",
        lambda events, sink, job: fold_stream(
            events.select("user_id", score), "user_id", ViewDivisor(), sink, job.state_dir
        ),
    )
    newest = F.max_by(F.struct("pages", "divisor"), "version").alias("newest")
    rows = out.groupBy("user_id").agg(newest)
    return rows.select("user_id", F.col("newest.pages").alias("events"), "newest.divisor")


def _last_rows(events):
    return events.select("user_id", "event_id", "event_type", "value")


def stream_last_events(spark, sf_dir):
    out = _run_in_slices(
        spark,
        sf_dir,
        "last-events",
        lambda events, sink, job: last_n_stream(
            _last_rows(events), "user_id", "event_id", sink, 5, job.state_dir
        ),
    )
    return latest(out, "user_id", "last")


# Rows without a page or a key, and broken messages


def _views_without_pages(events):
    views = _articles(events)
    return views.withColumn("page", F.when(F.col("page") != "page-3", F.col("page")))


def null_pages(spark, sf_dir):
    """Views without a page are one item like others."""
    views = page_views(_events(spark, sf_dir))
    views = views.withColumn("page", F.when(F.col("page") != "page-3", F.col("page")))
    ranked = jobs.top_pages(views, 3, "1 day")
    return _window_to_millis(ranked, "industry", "page", "n", "rank")


def stream_null_pages(spark, sf_dir):
    return _live_pages(spark, sf_dir, True, _views_without_pages)


def _rows_without_keys(events):
    user = F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id")
    return events.select(user, "event_id", "event_type")


def null_keys(spark, sf_dir):
    """Rows without a key are one group like others."""
    return last_n(_rows_without_keys(_events(spark, sf_dir)), "user_id", "event_id", 5)


def stream_null_keys(spark, sf_dir):
    out = _run_in_slices(
        spark,
        sf_dir,
        "null-keys",
        lambda events, sink, job: last_n_stream(
            _rows_without_keys(events), "user_id", "event_id", sink, 5, job.state_dir
        ),
    )
    return latest(out, "user_id", "last")


def _broken_messages(spark, sf_dir, settings):
    """Chat messages as JSON, every seventh turn broken off."""
    messages = table(spark, sf_dir, "conversations")
    text = F.to_json(F.struct(F.col("text").alias("message")))
    broken = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(7)) == 0
    value = F.when(broken, F.substring(text, 1, 12)).otherwise(text)
    records = messages.select(F.col("conv_id").cast("string").alias("key"), value.alias("value"))
    write_topic(records, jobs.MESSAGES_TOPIC, settings, mode="overwrite")


def broken_messages(spark, sf_dir):
    """The word count job over messages of which some are broken and left out by name."""
    settings = _scratch(spark, "broken", encoded=True)
    _broken_messages(spark, sf_dir, settings)
    sink = TopicSettings(root=settings.root)
    job = _job(spark, settings, "broken")
    jobs.run_word_count(spark, settings, sink, job, streaming=False, on_error="drop")
    counts = read_topic(spark, jobs.WORD_COUNTS_TOPIC, sink, "string", "bigint")
    return counts.select("key", F.col("value").alias("count"))


def stream_broken_messages(spark, sf_dir):
    settings = _scratch(spark, "stream-broken", encoded=True)
    _broken_messages(spark, sf_dir, settings)
    sink = TopicSettings(root=settings.root)
    job = _job(spark, settings, "stream-broken")
    jobs.run_word_count(spark, settings, sink, job, on_error="null", available_now=True)
    counts = read_table(spark, jobs.WORD_COUNTS_TOPIC, sink, "string", "bigint")
    return counts.select("key", F.col("value").alias("count"))


# Whole jobs, from topic to topic, stopped and started while records arrive


def _parts(spark, sf_dir, settings):
    folder = f"{settings.root}/parts"
    for part in time_slices(table(spark, sf_dir, "events"), folder):
        yield spark.read.schema(EVENTS).parquet(f"{folder}/{part}")


def _run_job(spark, sf_dir, name, records_of, topic, output, run, **settings) -> DataFrame:
    source = _scratch(spark, name, **settings)
    sink = TopicSettings(root=source.root)
    job = _job(spark, source, name)
    for part in _parts(spark, sf_dir, source):
        write_topic(records_of(part), topic, source)
        run(source, sink, job)
    return spark.read.parquet(sink.path(output))


def region_count_job(spark, sf_dir):
    out = _run_job(
        spark,
        sf_dir,
        "region-count-job",
        region_records,
        jobs.REGIONS_TOPIC,
        jobs.REGION_COUNTS_TOPIC,
        lambda *places: jobs.run_region_count(spark, *places, available_now=True),
        encoded=True,
    )
    return newest(out).select("key", F.col("value").alias("count"))


def _windowed_job(spark, sf_dir, per_record):
    return _run_job(
        spark,
        sf_dir,
        "windowed-job",
        lambda events: region_records(events).withColumn("partition", F.lit(0)),
        jobs.REGIONS_TOPIC,
        jobs.WINDOWED_COUNTS_TOPIC,
        lambda *places: jobs.run_windowed_region_count(
            spark, *places, per_record=per_record, available_now=True
        ),
        encoded=True,
    )


def windowed_count_job(spark, sf_dir):
    """One update per count and micro-batch; the last one of each key."""
    return newest(_windowed_job(spark, sf_dir, False))


def windowed_count_job_per_record(spark, sf_dir):
    """One update per record, all of them."""
    return _windowed_job(spark, sf_dir, True).select("key", "value")


def _top_pages_job(spark, sf_dir, emit):
    return _run_job(
        spark,
        sf_dir,
        "top-pages-job",
        lambda events: page_views(events).select(
            F.lit(None).cast("binary").alias("key"),
            F.struct("page", "industry", "flags").alias("value"),
            "timestamp",
        ),
        jobs.PAGE_VIEWS_TOPIC,
        jobs.TOP_PAGES_TOPIC,
        lambda *places: jobs.run_top_pages(
            spark, *places, n=3, size="1 day", emit=emit, available_now=True
        ),
        encoded=True,
    )


def top_pages_job(spark, sf_dir):
    return newest(_top_pages_job(spark, sf_dir, "update"))


def top_pages_job_closed(spark, sf_dir):
    """Each window once, after it closed, by one streaming plan in append mode."""
    return _top_pages_job(spark, sf_dir, "final").select("key", "value")


def default_types(spark, sf_dir):
    """A topic read with the settings' own types, once before and once after more records came."""
    settings = _scratch(spark, "defaults", key_type="bigint", value_type="string", encoded=True)
    sink = TopicSettings(root=settings.root)
    job = _job(spark, settings, "defaults")
    for part in _parts(spark, sf_dir, settings):
        write_topic(region_records(part), jobs.REGIONS_TOPIC, settings)
        records = read_topic(spark, jobs.REGIONS_TOPIC, settings, streaming=True)
        read = records.select("key", "value")
        write_topic(read, "copied", sink, job=job, available_now=True)
    return read_topic(spark, "copied", sink, "bigint", "string").select("key", "value")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: region counts per minute."""
    return region_count_windowed(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name."""
    return own_queries() | (llm_queries.queries() if llm_queries else {})


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            word_count,
            document_words,
            message_sizes,
            region_count,
            event_type_count,
            region_count_windowed,
            region_count_hopping,
            region_count_hopping_wide,
            hourly_article_views,
            record_count,
            article_views,
            region_changelog,
            windowed_changelog,
            top_pages,
            bottom_pages,
            top_pages_text,
            top_pages_hourly,
            top_words,
            last_events,
            regroup_aggregate,
            fold_pages,
            page_spread,
            json_decode,
            region_json_topic,
            top_pages_topic,
            region_lines,
            topic_round_trip,
            word_count_job,
            printed_counts,
            stream_region_count,
            stream_region_updates,
            stream_region_state,
            stream_windowed_count,
            stream_hopping_count,
            stream_changes,
            stream_windowed_changes,
            stream_top_pages,
            stream_top_pages_live,
            stream_bottom_pages_live,
            stream_table_fold,
            stream_table_product,
            stream_fold,
            stream_last_events,
            stream_windowed_updates,
            stream_hopping_updates,
            stream_late_records,
            null_pages,
            stream_null_pages,
            null_keys,
            stream_null_keys,
            broken_messages,
            stream_broken_messages,
            region_count_job,
            windowed_count_job,
            windowed_count_job_per_record,
            top_pages_job,
            top_pages_job_closed,
            default_types,
        )
    }


def _words_sql(text: str) -> str:
    """The words of a text: no trailing empty words, empty text is one empty word."""
    return (
        f"CASE WHEN {text} = '' THEN [''] WHEN rtrim({text}, ' ') = '' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({text}, ' '), ' ') END"
    )


def _word_count_sql(source: str) -> str:
    words = _words_sql("lower(text)")
    return (
        f"SELECT word AS key, count(*) AS count FROM "
        f"(SELECT unnest({words}) AS word FROM {source}) GROUP BY word"
    )


_PAGE_VIEWS = """
    SELECT 'page-' || (user_id % 20) AS page, event_type AS industry,
           CASE WHEN (props ->> '$.k')::INT < 50 THEN 'ART' ELSE 'AD' END AS flags, ts
    FROM events
"""


def _start_ms(width: str) -> str:
    return f"epoch_ms(time_bucket(INTERVAL '{width}', ts))"


def _page_counts_sql(width: str) -> str:
    return (
        f"SELECT {_start_ms(width)} AS window_start, industry, page, count(*) AS n "
        f"FROM ({_PAGE_VIEWS}) WHERE contains(flags, 'ART') GROUP BY ALL"
    )


def _top_pages_sql(width: str, n: int, direction: str) -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start, industry "
        f"ORDER BY n {direction}, page) AS rank FROM ({_page_counts_sql(width)})) "
        f"WHERE rank <= {n}"
    )


def _top_text_sql(width: str, n: int) -> str:
    return (
        "SELECT window_start, industry, "
        "string_agg(page, chr(10) ORDER BY rank) || chr(10) AS value "
        f"FROM ({_top_pages_sql(width, n, 'DESC')}) GROUP BY ALL"
    )


def _hopping_sql(hours: int, key: str) -> str:
    return f"""
        SELECT epoch_ms(time_bucket(INTERVAL '1 hour', ts)) - i * 3600000 AS {{start}},
               event_type AS {key}, count(*) AS count
        FROM events, range(0, {hours}) AS steps(i) GROUP BY ALL
    """


# A stream emits a window once the latest time less the delay of one day has passed its end.
def _closed(start: str, width_ms: int) -> str:
    latest_ms = "(SELECT max(epoch_ms(ts)) FROM events)"
    return f"{start} + {width_ms} <= {latest_ms} - 86400000"


_DAY_MS = 86_400_000


def _null_pages_sql() -> str:
    views = _PAGE_VIEWS.replace(
        "'page-' || (user_id % 20) AS page",
        "CASE WHEN user_id % 20 <> 3 THEN 'page-' || (user_id % 20) END AS page",
    )
    return f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start, industry
            ORDER BY n DESC, page NULLS FIRST) AS rank FROM
            (SELECT {_start_ms('1 day')} AS window_start, industry, page, count(*) AS n
             FROM ({views}) WHERE contains(flags, 'ART') GROUP BY ALL))
        WHERE rank <= 3
    """


# Events of the first fifth of the time that arrive with the last fifth are too late.
_IN_TIME = """
    SELECT events.* FROM events, (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events)
    WHERE NOT (event_id % 89 = 0 AND (epoch_us(ts) - a) * 5 // (b - a + 1) = 0)
"""


def _json_counts_sql(counts: str) -> str:
    return f"""
        SELECT '{{"windowStart":' || start || ',"region":"' || region || '"}}' AS key,
               '{{"count":' || count || ',"region":"' || region || '"}}' AS value
        FROM ({counts})
    """


def oracle_sql() -> dict[str, str]:
    """DuckDB counterparts of ``queries()``."""
    return own_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def own_sql() -> dict[str, str]:
    minute_counts = (
        f"SELECT {_start_ms('1 minute')} AS start, event_type AS region, count(*) AS count "
        "FROM events GROUP BY ALL"
    )
    changes = (
        'SELECT event_id AS "offset", event_type AS key, count(*) OVER ({part} '
        "ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS count {start} FROM events"
    )
    plain_changes = changes.format(part="PARTITION BY event_type", start="")
    daily_changes = changes.format(
        part="PARTITION BY event_type, time_bucket(INTERVAL '1 day', ts)",
        start=f", {_start_ms('1 day')} AS window_start",
    )
    type_counts = "SELECT event_type AS key, count(*) AS count FROM events GROUP BY ALL"
    top_three = _top_pages_sql("1 day", 3, "DESC")
    last_five = (
        "SELECT * FROM (SELECT user_id, event_id, event_type, value, row_number() OVER "
        "(PARTITION BY user_id ORDER BY event_id DESC) AS rank FROM events) WHERE rank <= 5"
    )
    top_texts = f"""
        SELECT '{{"windowStart":' || window_start || ',"windowEnd":'
            || (window_start + {_DAY_MS}) || ',"key":"' || industry || '"}}' AS key, value
        FROM ({_top_text_sql('1 day', 3)})"""
    closed_texts = f"{top_texts} WHERE {_closed('window_start', _DAY_MS)}"
    last_of_null = (
        "SELECT * FROM (SELECT user_id, event_id, event_type, row_number() OVER "
        "(PARTITION BY user_id ORDER BY event_id DESC) AS rank FROM (SELECT CASE WHEN user_id % 10 "
        "<> 0 THEN user_id END AS user_id, event_id, event_type FROM events)) WHERE rank <= 5"
    )
    whole_messages = _word_count_sql("(SELECT * FROM conversations WHERE (conv_id + turn) % 7 <> 0)")
    minute_changes = (
        f"SELECT {_start_ms('1 minute')} AS start, event_type AS region, count(*) OVER (PARTITION BY "
        "event_type, time_bucket(INTERVAL '1 minute', ts) ORDER BY event_id ROWS UNBOUNDED "
        "PRECEDING) AS count FROM events"
    )
    hopping_two = _hopping_sql(2, "region").format(start='"windowStart"')
    stream_hopping = _hopping_sql(2, "key").format(start="window_start")
    return {
        "word_count": _word_count_sql("conversations"),
        "document_words": _word_count_sql("documents"),
        "message_sizes": f"""
            SELECT conv_id, turn, count(*) AS words FROM
            (SELECT conv_id, turn, unnest({_words_sql('text')}) AS word FROM conversations)
            GROUP BY ALL""",
        "region_count": """
            SELECT r_name AS key, count(*) AS count FROM orders
            JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
        "event_type_count": type_counts,
        "region_count_windowed": f"""
            SELECT start AS "windowStart", region, count FROM ({minute_counts})""",
        "region_count_hopping": hopping_two,
        "region_count_hopping_wide": _hopping_sql(24, "region").format(start='"windowStart"'),
        "hourly_article_views": f"""
            SELECT {_start_ms('1 hour')} AS window_start, page, industry, flags, count(*) AS count
            FROM ({_PAGE_VIEWS}) WHERE contains(flags, 'ART') GROUP BY ALL""",
        "record_count": f"""
            SELECT page, industry, flags, count(*) AS count FROM ({_PAGE_VIEWS}) GROUP BY ALL""",
        "article_views": f"""
            SELECT epoch_us(ts) AS time, page, industry, flags FROM ({_PAGE_VIEWS})
            WHERE contains(flags, 'ART')""",
        "region_changelog": plain_changes,
        "windowed_changelog": daily_changes,
        "top_pages": top_three,
        "bottom_pages": _top_pages_sql("1 day", 3, "ASC"),
        "top_pages_text": _top_text_sql("1 day", 3),
        "top_pages_hourly": _top_text_sql("1 hour", 100),
        "top_words": f"""
            SELECT * FROM (SELECT role, value, n, row_number() OVER
                (PARTITION BY role ORDER BY n DESC, value) AS rank
            FROM (SELECT role, value, count(*) AS n FROM
                (SELECT role, unnest({_words_sql('lower(text)')}) AS value FROM conversations)
            GROUP BY ALL)) WHERE rank <= 1500""",
        "last_events": last_five,
        "regroup_aggregate": f"""
            SELECT window_start, industry, 'views' AS unit, count(*) AS pages,
                   sum(n)::BIGINT AS views
            FROM ({_page_counts_sql('1 day')}) GROUP BY ALL""",
        "fold_pages": f"""
            SELECT window_start, industry, count(*) AS pages,
                   list_reduce(list(n), lambda a, b: gcd(a, b)) AS divisor
            FROM ({_page_counts_sql('1 day')}) GROUP BY ALL""",
        "page_spread": f"""
            SELECT window_start, industry, count(*) AS pages, sum(n)::BIGINT AS views,
                   max(n) AS most
            FROM ({_page_counts_sql('1 day')}) GROUP BY ALL""",
        "json_decode": "SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events",
        "region_json_topic": _json_counts_sql(minute_counts),
        "top_pages_topic": top_texts,
        "region_lines": """
            SELECT event_type AS key,
                   event_type || chr(10) || upper(event_type) || chr(10) AS value
            FROM events GROUP BY event_type""",
        "topic_round_trip": f"""
            SELECT {_start_ms('1 hour')} AS window_start, event_type AS key, count(*) AS count
            FROM events GROUP BY ALL""",
        "word_count_job": _word_count_sql("conversations"),
        "printed_counts": _word_count_sql("conversations"),
        "stream_region_count": type_counts,
        "stream_region_updates": type_counts,
        "stream_region_state": type_counts,
        "stream_windowed_count": f"""
            SELECT start AS window_start, region AS key, count FROM ({minute_counts})
            WHERE {_closed('start', 60_000)}""",
        "stream_hopping_count": f"""
            SELECT * FROM ({stream_hopping}) WHERE {_closed('window_start', 7_200_000)}""",
        "stream_changes": plain_changes,
        "stream_windowed_changes": daily_changes,
        "stream_top_pages": f"""
            SELECT * FROM ({top_three}) WHERE {_closed('window_start', _DAY_MS)}""",
        "stream_top_pages_live": top_three,
        "stream_bottom_pages_live": _top_pages_sql("1 day", 3, "ASC"),
        "stream_table_fold": f"""
            SELECT event_type AS industry, count(DISTINCT user_id % 20) AS items,
                   count(*) AS total
            FROM events WHERE (props ->> '$.k')::INT < 50 GROUP BY ALL""",
        # SQL multiplies 64-bit numbers modulo the prime one after the other, in wider ones.
        "stream_table_product": """
            SELECT industry, count(*) AS items, list_reduce(list_prepend(1::HUGEINT, list(n::HUGEINT)),
                lambda a, n: a * (n % 2147483646 + 1) % 2147483647)::BIGINT AS product
            FROM (SELECT event_type AS industry, user_id % 20 AS page, count(*) AS n
                  FROM events WHERE (props ->> '$.k')::INT < 50 GROUP BY ALL)
            GROUP BY industry""",
        "stream_fold": """
            SELECT user_id, count(*) AS events, list_reduce(list(n), lambda a, b: gcd(a, b)) AS divisor
            FROM (SELECT user_id, (props ->> '$.k')::BIGINT AS n FROM events) GROUP BY user_id""",
        "stream_last_events": last_five,
        "stream_windowed_updates": f"""
            SELECT start AS window_start, region AS key, count FROM ({minute_counts})""",
        "stream_hopping_updates": stream_hopping,
        "stream_late_records": f"""
            SELECT {_start_ms('1 hour')} AS window_start, event_type AS key, count(*) AS count
            FROM ({_IN_TIME}) GROUP BY ALL""",
        "null_pages": _null_pages_sql(),
        "stream_null_pages": _null_pages_sql(),
        "null_keys": last_of_null,
        "stream_null_keys": last_of_null,
        "broken_messages": whole_messages,
        "stream_broken_messages": whole_messages,
        "region_count_job": type_counts,
        "windowed_count_job": _json_counts_sql(minute_counts),
        "windowed_count_job_per_record": _json_counts_sql(minute_changes),
        "top_pages_job": top_texts,
        "top_pages_job_closed": closed_texts,
        "default_types": "SELECT event_id AS key, event_type AS value FROM events",
    }
