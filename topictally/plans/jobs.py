"""The five jobs (JOB-1 to JOB-5) as plans over a topic, and as runs from topic to topic.

The plan functions take a batch or streaming topic with decoded values and compose operators only;
the ``run_*`` functions read, plan and write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from topictally.functions.text import is_article, lines, lower_words
from topictally.operators.changes import changelog
from topictally.operators.counts import count_by_key, windowed_count
from topictally.operators.ranking import top_n, top_n_text
from topictally.operators.rows import (
    flat_map_values,
    flatten_window,
    keep,
    map_values,
    regroup,
    rekey,
)
from topictally.sources.codecs import decode_avro, encode_json, encode_window_key, schema_text
from topictally.sources.sinks import batch_writer, print_table, stream_writer, write_topic
from topictally.sources.topics import TopicSettings, read_topic
from topictally.streaming.changes import stream_changelog
from topictally.streaming.jobs import Job
from topictally.streaming.ranking import top_n_closed, top_n_stream

# Topic names, window sizes and list length the jobs have unless told otherwise.
MESSAGES_TOPIC = "irc-messages-log"
WORD_COUNTS_TOPIC = "cw1"
REGIONS_TOPIC = "step1"
REGION_COUNTS_TOPIC = "step2"
WINDOWED_COUNTS_TOPIC = "step3"
PAGE_VIEWS_TOPIC = "PageViews"
TOP_PAGES_TOPIC = "TopNewsPerIndustry"
REGION_WINDOW = "1 minute"
ARTICLE_WINDOW = "1 hour"
TOP_PAGES = 100

MESSAGE = "message string"
PAGE_VIEW = "page string, industry string, flags string"


def word_count(messages: DataFrame) -> DataFrame:
    """Occurrences of each lower-cased word of ``value.message``: key, count."""
    words = flat_map_values(messages, lower_words("value.message"))
    return count_by_key(rekey(words))


def region_count(regions: DataFrame, weight: str | None = None) -> DataFrame:
    """Records per region: key, count."""
    return count_by_key(rekey(regions), weight=weight)


def windowed_region_count(
    regions: DataFrame,
    size: int | str = REGION_WINDOW,
    advance: int | str | None = None,
    delay: int | str | None = "1 day",
) -> DataFrame:
    """Records per region and window: windowStart, region, count."""
    counts = windowed_count(rekey(regions), size=size, advance=advance, delay=delay)
    return flatten_window(counts).withColumnRenamed("key", "region")


def region_messages(counts: DataFrame) -> DataFrame:
    """Windowed region counts as JSON key and value."""
    return encode_json(counts, ["windowStart", "region"], ["count", "region"])


def hourly_article_views(
    views: DataFrame, size: int | str = ARTICLE_WINDOW, delay: int | str | None = "1 day"
) -> DataFrame:
    """Views per article record and window: window, the record's fields, count."""
    articles = keep(views, is_article())
    return windowed_count(articles, ["page", "industry", "flags"], size, delay=delay)


def page_counts(views: DataFrame, size: int | str = ARTICLE_WINDOW) -> DataFrame:
    """Article views by window and industry, with the record to rank: page, n.

    Groups by the ranked fields only; a page is one item whatever its other fields are.
    """
    counts = windowed_count(keep(views, is_article()), ["industry", "page"], size)
    return regroup(counts, "industry", {"page": "page", "n": "count"})


def top_pages(
    views: DataFrame,
    n: int = TOP_PAGES,
    size: int | str = ARTICLE_WINDOW,
    descending: bool = True,
) -> DataFrame:
    """The most viewed article pages per window and industry, with rank. Batch input."""
    pages = page_counts(views, size)
    return top_n(pages, ["window", "industry"], "n", n, descending, ties=["page"])


def top_pages_text(
    views: DataFrame,
    n: int = TOP_PAGES,
    size: int | str = ARTICLE_WINDOW,
    descending: bool = True,
) -> DataFrame:
    """The top pages of a window and industry as text: window, industry, value. Batch input."""
    pages = page_counts(views, size)
    return top_n_text(pages, ["window", "industry"], "n", "page", n, descending, ties=["page"])


def _run_counts(
    counts: DataFrame, job: Job, topic: str, sink: TopicSettings, print_updates: bool | Callable[[str], None], run: dict
) -> StreamingQuery | None:
    show = print_updates if callable(print_updates) else print
    if counts.isStreaming and print_updates:
        write = batch_writer(topic, sink, "key", "count")

        def print_and_write(changed: DataFrame, batch_id: int) -> None:
            # Used twice, and the counts' state is to be updated once.
            changed.persist()
            try:
                print_table(changed, show=show)
                write(changed, batch_id)
            finally:
                changed.unpersist()

        return job.run(counts.writeStream.outputMode("update").foreachBatch(print_and_write), **run)
    if print_updates:
        print_table(counts, show=show)
    mode = "update" if counts.isStreaming else "overwrite"
    return write_topic(counts, topic, sink, "key", "count", mode=mode, job=job, **run)


def run_word_count(
    spark: SparkSession,
    source: TopicSettings,
    sink: TopicSettings,
    job: Job,
    topic: str = MESSAGES_TOPIC,
    output: str = WORD_COUNTS_TOPIC,
    streaming: bool = True,
    print_updates: bool | Callable[[str], None] = False,
    on_error: str = "fail",
    **run,
) -> StreamingQuery | None:
    """JOB-1: messages to word counts. ``run`` goes to ``Job.run``, as in all runs.

    ``on_error`` says what a broken message does, see ``read_topic``; ``print_updates`` may be the
    function that prints a row.
    """
    messages = read_topic(spark, topic, source, "string", MESSAGE, streaming, on_error)
    return _run_counts(word_count(messages), job, output, sink, print_updates, run)


def run_region_count(
    spark: SparkSession,
    source: TopicSettings,
    sink: TopicSettings,
    job: Job,
    topic: str = REGIONS_TOPIC,
    output: str = REGION_COUNTS_TOPIC,
    streaming: bool = True,
    print_updates: bool | Callable[[str], None] = False,
    **run,
) -> StreamingQuery | None:
    """JOB-2: region records to region counts."""
    regions = read_topic(spark, topic, source, "bigint", "string", streaming)
    return _run_counts(region_count(regions), job, output, sink, print_updates, run)


def run_windowed_region_count(
    spark: SparkSession,
    source: TopicSettings,
    sink: TopicSettings,
    job: Job,
    topic: str = REGIONS_TOPIC,
    output: str = WINDOWED_COUNTS_TOPIC,
    streaming: bool = True,
    per_record: bool = False,
    **run,
) -> StreamingQuery | None:
    """JOB-3: region records to the updates of their windowed counts, as JSON.

    A stream gives one update per count and micro-batch, or with ``per_record`` one per record.
    A batch run gives one update per record.
    """
    regions = rekey(read_topic(spark, topic, source, "bigint", "string", streaming))
    order = ["offset", "partition"]

    def messages(changes: DataFrame) -> DataFrame:
        return region_messages(flatten_window(changes).withColumnRenamed("key", "region"))

    if not streaming:
        changes = changelog(regions, order=order, size=REGION_WINDOW)
        return write_topic(messages(changes), output, sink, mode="overwrite")
    if per_record:
        write = batch_writer(output, sink)
        writer = stream_changelog(
            regions,
            lambda changes, batch_id: write(messages(changes), batch_id),
            job.state_dir,
            order=order,
            size=REGION_WINDOW,
            hold=source.is_kafka,
        )
        return job.run(writer, **run)
    counts = messages(windowed_count(regions, size=REGION_WINDOW))
    return job.run(stream_writer(counts, output, sink, mode="update"), **run)


def run_top_pages(
    spark: SparkSession,
    source: TopicSettings,
    sink: TopicSettings,
    job: Job,
    topic: str = PAGE_VIEWS_TOPIC,
    output: str = TOP_PAGES_TOPIC,
    streaming: bool = True,
    emit: str = "update",
    n: int = TOP_PAGES,
    size: int | str = ARTICLE_WINDOW,
    descending: bool = True,
    avro_schema: str | None = None,
    avro_header_bytes: int = 0,
    on_error: str = "fail",
    **run,
) -> StreamingQuery | None:
    """JOB-4 and JOB-5: page views to the top pages per window and industry, as text.

    A stream gives the newest text of each window and industry that changed, per micro-batch, or
    with ``emit="final"`` one text once a window has closed, as one plan in append mode. ``on_error`` is
    as in ``read_topic``.

    Views are JSON records, or with ``avro_schema`` (JSON text, or the path of a file that holds it) Avro
    records after ``avro_header_bytes`` of other content.
    """
    scan = read_topic(
        spark, topic, source, "binary", "binary" if avro_schema else PAGE_VIEW, streaming, on_error
    )
    if avro_schema:
        scan = decode_avro(scan, schema_text(spark, avro_schema), header_bytes=avro_header_bytes)
    views = scan.select("value.page", "value.industry", "value.flags", "timestamp")
    if not streaming:
        texts = encode_window_key(top_pages_text(views, n, size, descending), "industry")
        return write_topic(texts, output, sink, mode="overwrite")
    articles = keep(views, is_article())
    if emit == "final":
        tops = top_n_closed(articles, "industry", "page", n, size, descending=descending)
        texts = tops.select("window", "industry", lines(F.col("top.item")).alias("value"))
        return write_topic(encode_window_key(texts, "industry"), output, sink, job=job, **run)
    write = batch_writer(output, sink)

    def write_texts(ranked: DataFrame, batch_id: int) -> None:
        bounds = F.struct(
            F.timestamp_millis("window_start_ms").alias("start"),
            F.timestamp_millis("window_end_ms").alias("end"),
        )
        pages = map_values(
            ranked.select(bounds.alias("window"), "industry", F.col("top.item").alias("value")),
            lines,
        )
        write(encode_window_key(pages, "industry"), batch_id)

    writer = top_n_stream(
        articles,
        "industry",
        "page",
        write_texts,
        n,
        size,
        descending=descending,
        emit=emit,
        state_dir=job.state_dir,
    )
    return job.run(writer, **run)
