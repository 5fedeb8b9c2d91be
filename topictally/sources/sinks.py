"""Topic sinks (SNK-1 to SNK-4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from topictally.sources.codecs import encode_column, json_text
from topictally.sources.topics import ENVELOPE, TopicSettings

BatchSink = Callable[[DataFrame, int], None]


def topic_records(
    df: DataFrame, settings: TopicSettings, key: str = "key", value: str = "value"
) -> DataFrame:
    """Key, value and any envelope columns at hand; as bytes for Kafka and encoded file topics."""
    columns = [F.col(key).alias("key"), F.col(value).alias("value")]
    if settings.is_kafka or settings.encoded:
        types = [df.schema[key].dataType, df.schema[value].dataType]
        columns = [
            encode_column(c, t).alias(n) for c, t, n in zip(columns, types, ("key", "value"))
        ]
    # The broker sets topic, partition and offset itself; the topic comes from the sink's option.
    passed = ["timestamp"] if settings.is_kafka else list(ENVELOPE)
    passed = [c for c in passed if c in df.columns and c not in (key, value)]
    return df.select(*columns, *passed)


def batch_writer(
    topic: str,
    settings: TopicSettings,
    key: str | None = "key",
    value: str | None = "value",
) -> BatchSink:
    """A sink for the results of single micro-batches, for ``foreachBatch``.

    A file topic gets one folder per micro-batch, replaced if the batch is run again, so a
    restart neither loses nor doubles records. Read it back with the column ``batch``. Without
    ``key`` all columns are written as they are.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df if key is None else topic_records(df, settings, key, value)
        if settings.is_kafka:
            rows.write.format("kafka").options(**settings.options).option("topic", topic).save()
        else:
            folder = f"{settings.path(topic)}/batch={batch_id}"
            rows.write.mode("overwrite").format(settings.fmt).save(folder)

    return write


def stream_writer(
    df: DataFrame,
    topic: str,
    settings: TopicSettings,
    key: str = "key",
    value: str = "value",
    mode: str = "append",
) -> DataStreamWriter:
    """A writer to a topic, to be started by a ``Job``.

    Spark's file sink only appends, so counts that change go through ``batch_writer``.
    """
    if settings.is_kafka:
        writer = topic_records(df, settings, key, value).writeStream.outputMode(mode)
        return writer.format("kafka").options(**settings.options).option("topic", topic)
    if mode == "append":
        writer = topic_records(df, settings, key, value).writeStream.outputMode(mode)
        return writer.format(settings.fmt).option("path", settings.path(topic))
    return df.writeStream.outputMode(mode).foreachBatch(batch_writer(topic, settings, key, value))


def write_topic(
    df: DataFrame,
    topic: str,
    settings: TopicSettings,
    key: str = "key",
    value: str = "value",
    mode: str = "append",
    job=None,
    **run,
) -> StreamingQuery | None:
    """Write records to a topic.

    Batch: ``mode`` is Spark's save mode. Stream: ``mode`` is the output mode, ``job`` the
    ``streaming.Job`` to run it and ``run`` the arguments of ``Job.run``.
    """
    if df.isStreaming:
        if job is None:
            raise ValueError("writing a stream needs a job")
        return job.run(stream_writer(df, topic, settings, key, value, mode), **run)
    records = topic_records(df, settings, key, value)
    if settings.is_kafka:
        records.write.format("kafka").options(**settings.options).option("topic", topic).save()
    else:
        records.write.mode(mode).format(settings.fmt).save(settings.path(topic))
    return None


def print_table(
    df: DataFrame, mode: str = "update", show: Callable[[str], None] = print
) -> DataStreamWriter | None:
    """Print every row, as JSON, where it lies; for a stream, a writer that prints every update.

    Each task calls ``show`` for its rows, by default to its executor's output. No row passes the
    driver and none is left out (SNK-4).
    """

    def print_rows(rows: DataFrame, batch_id: int = 0) -> None:
        texts = rows.select(json_text(F.struct("*")).alias("row"))
        texts.foreachPartition(lambda part: [show(row[0]) for row in part] and None)

    if not df.isStreaming:
        print_rows(df)
        return None
    return df.writeStream.outputMode(mode).foreachBatch(print_rows)
