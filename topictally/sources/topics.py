"""Topic scans (SRC-1 to SRC-3)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from topictally.operators.tables import newest
from topictally.sources.codecs import as_type, decode_column, decode_json

# The columns of a topic besides key and value.
ENVELOPE = {
    "topic": StringType(),
    "partition": IntegerType(),
    "offset": LongType(),
    "timestamp": TimestampType(),
}


@dataclass(frozen=True)
class TopicSettings:
    """Where topics are and the types used where a scan names none (SRC-2).

    ``fmt`` is ``"kafka"`` or a Spark file format; a file topic is the folder ``root/<topic>``.
    ``encoded`` says that a file topic holds key and value as bytes, as a broker does.
    ``options`` go to Spark as they are (brokers, files or offsets per trigger, ...).
    """

    root: str | None = None
    fmt: str = "parquet"
    key_type: DataType | str = "string"
    value_type: DataType | str = "string"
    starting: str = "earliest"
    encoded: bool = False
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_kafka(self) -> bool:
        return self.fmt == "kafka"

    def path(self, topic: str) -> str:
        if self.root is None:
            raise ValueError("a file topic needs a root folder")
        return f"{self.root.rstrip('/')}/{topic}"


def kafka_options(topic: str, settings: TopicSettings, streaming: bool) -> dict[str, str]:
    """Options of a Kafka scan. A batch always reads to the present end."""
    if "kafka.bootstrap.servers" not in settings.options:
        raise ValueError("a kafka topic needs the option kafka.bootstrap.servers")
    options = {"subscribe": topic, "startingOffsets": settings.starting, **settings.options}
    if not streaming:
        if settings.starting == "latest":
            raise ValueError("a batch scan cannot start at the end of a topic")
        options.setdefault("endingOffsets", "latest")
    return options


def envelope_schema(key_type: DataType, value_type: DataType) -> StructType:
    fields = [StructField("key", key_type), StructField("value", value_type)]
    return StructType([*fields, *(StructField(n, t) for n, t in ENVELOPE.items())])


def read_table(
    spark: SparkSession,
    topic: str,
    settings: TopicSettings,
    key_type: DataType | str | None = None,
    value_type: DataType | str | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """An update topic as the table it stands for: key and its last value, removed keys left out.

    File topics are ordered by the micro-batches ``batch_writer`` wrote, brokers' by offset. A topic whose
    updates have no batch holds one batch; see ``operators.newest``.
    """
    records = read_topic(spark, topic, settings, key_type, value_type, on_error=on_error, batch=True)
    return newest(records, order="offset" if settings.is_kafka else "batch")


def read_topic(
    spark: SparkSession,
    topic: str,
    settings: TopicSettings,
    key_type: DataType | str | None = None,
    value_type: DataType | str | None = None,
    streaming: bool = False,
    on_error: str = "fail",
    batch: bool = False,
) -> DataFrame:
    """Scan a topic as key, value, topic, partition, offset, timestamp with typed key and value.

    Without stored progress a stream starts at ``settings.starting``; with a checkpoint it goes
    on where it stopped. File topics are always read from their first file. Envelope columns a
    file topic does not store are null.

    ``on_error`` says what a value that is no JSON record does, as in ``decode_json``: it ends the
    query (``"fail"``), gives null fields (``"null"``), or is left out (``"drop"``). ``batch`` adds the
    number of the micro-batch that wrote a record of a file topic.
    """
    if on_error not in ("fail", "null", "drop"):
        raise ValueError(f"on_error must be null, fail or drop, not {on_error!r}")
    key_type = as_type(key_type or settings.key_type)
    value_type = as_type(value_type or settings.value_type)
    reader = spark.readStream if streaming else spark.read
    more: list[str] = []
    if settings.is_kafka:
        raw = reader.format("kafka").options(**kafka_options(topic, settings, streaming)).load()
    else:
        if settings.starting != "earliest":
            raise ValueError("a file topic is always read from its first file")
        types = (BinaryType(), BinaryType()) if settings.encoded else (key_type, value_type)
        schema = envelope_schema(*types)
        if batch:
            more, schema = ["batch"], schema.add("batch", LongType())
        reader = reader.format(settings.fmt).schema(schema)
        raw = reader.options(**settings.options).load(settings.path(topic))
    if not (settings.is_kafka or settings.encoded):
        return raw
    if on_error == "drop" and isinstance(value_type, StructType):
        decoded = decode_json(raw.withColumn("value", F.col("value").cast("string")), value_type, on_error=on_error)
        return decoded.select(decode_column(F.col("key"), key_type).alias("key"), "value", *ENVELOPE, *more)
    errors = "null" if on_error == "drop" else on_error
    return raw.select(
        decode_column(F.col("key"), key_type, errors).alias("key"),
        decode_column(F.col("value"), value_type, errors).alias("value"),
        *ENVELOPE,
        *more,
    )
