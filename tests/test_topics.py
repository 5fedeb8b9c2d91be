import struct
from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topictally.functions.windows import start_millis
from topictally.operators import windowed_count
from topictally.sources import (
    TopicSettings,
    decode_avro,
    decode_column,
    decode_json,
    encode_column,
    encode_json,
    encode_window_key,
    print_table,
    read_topic,
    write_topic,
)
from topictally.sources.sinks import topic_records
from topictally.sources.topics import kafka_options

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
LONGS = [0, 1, -1, 255, 2**63 - 1, -(2**63), None]


def test_longs_are_eight_big_endian_bytes(spark):
    df = spark.createDataFrame([(n,) for n in LONGS], "n bigint")
    encoded = df.select("n", encode_column(F.col("n"), "bigint").alias("b"))
    for row in encoded.collect():
        assert row.b == (None if row.n is None else bytearray(struct.pack(">q", row.n)))
    back = encoded.select("n", decode_column(F.col("b"), "bigint").alias("m"))
    assert all(r.n == r.m for r in back.collect())


def test_text_records_and_bytes_round_trip(spark):
    df = spark.createDataFrame([("é", ("x", None)), (None, None)], "s string, r struct<a: string, b: bigint>")
    record = df.schema["r"].dataType
    encoded = df.select(
        "s",
        "r",
        encode_column(F.col("s"), "string").alias("sb"),
        encode_column(F.col("r"), record).alias("rb"),
    )
    first = encoded.first()
    assert bytes(first.sb) == "é".encode() and bytes(first.rb) == b'{"a":"x","b":null}'
    back = encoded.select(
        "s", "r", decode_column(F.col("sb"), "string").alias("s2"), decode_column(F.col("rb"), record).alias("r2")
    )
    assert all(r.s == r.s2 and r.r == r.r2 for r in back.collect())
    for function in (encode_column, decode_column):
        with pytest.raises(ValueError):
            function(F.col("s"), "double")


@pytest.mark.parametrize("encoded", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_file_topic(spark, tmp_path, encoded, fmt):
    settings = TopicSettings(root=str(tmp_path), fmt=fmt, encoded=encoded)
    rows = [(n, f"v{n}", n, AT) for n in (-5, 0, 7)]
    df = spark.createDataFrame(rows, "key bigint, value string, offset bigint, timestamp timestamp")
    write_topic(df, "t", settings)
    write_topic(df, "t", settings)
    read = read_topic(spark, "t", settings, "bigint", "string")
    assert read.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    expected = sorted([(n, f"v{n}", n, None) for n in (-5, 0, 7)] * 2, key=repr)
    assert rows_of(read, "key", "value", "offset", "partition") == expected
    assert {r[0] for r in read.select(F.unix_millis("timestamp")).collect()} == {1_704_067_200_000}


def test_default_types(spark, tmp_path):
    """A scan that names no types takes those of the settings."""
    settings = TopicSettings(root=str(tmp_path), encoded=True, key_type="binary", value_type="page string, n bigint")
    df = spark.createDataFrame([(bytearray(b"k"), ("p", 3))], "key binary, value struct<page: string, n: bigint>")
    write_topic(df, "t", settings)
    read = read_topic(spark, "t", settings)
    assert dict(read.dtypes)["key"] == "binary"
    assert rows_of(read.select("value.*"), "page", "n") == [("p", 3)]


def test_starting_place(spark, tmp_path):
    with pytest.raises(ValueError):
        read_topic(spark, "t", TopicSettings(root=str(tmp_path), starting="latest"))
    with pytest.raises(ValueError):
        read_topic(spark, "t", TopicSettings())


def test_kafka_options():
    settings = TopicSettings(fmt="kafka", options={"kafka.bootstrap.servers": "b:9092", "maxOffsetsPerTrigger": "5"})
    stream = kafka_options("t", settings, streaming=True)
    assert stream == {
        "subscribe": "t",
        "startingOffsets": "earliest",
        "kafka.bootstrap.servers": "b:9092",
        "maxOffsetsPerTrigger": "5",
    }
    assert kafka_options("t", settings, streaming=False)["endingOffsets"] == "latest"
    late = TopicSettings(fmt="kafka", starting="latest", options=settings.options)
    assert kafka_options("t", late, streaming=True)["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_options("t", late, streaming=False)
    with pytest.raises(ValueError):
        kafka_options("t", TopicSettings(fmt="kafka"), streaming=True)


def test_kafka_records_are_bytes(spark):
    settings = TopicSettings(fmt="kafka", options={"kafka.bootstrap.servers": "b:9092"})
    df = spark.createDataFrame([("a", 3, 9)], "word string, count bigint, offset bigint")
    records = topic_records(df, settings, "word", "count")
    assert records.dtypes == [("key", "binary"), ("value", "binary")]
    assert bytes(records.first().value) == struct.pack(">q", 3)


BAD_JSON = [("{bad",), ('{"message":"hi"}',), ('{"x":1}',)]


def test_decode_json(spark):
    df = spark.createDataFrame(BAD_JSON, "value string")
    nulls = decode_json(df, "message string")
    assert [r[0] for r in nulls.select("value.message").collect()] == [None, "hi", None]
    dropped = decode_json(df, "message string", on_error="drop")
    assert dropped.schema["value"].dataType == StructType.fromDDL("message string")
    assert [r[0] for r in dropped.select("value.message").collect()] == ["hi", None]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        decode_json(df, "message string", on_error="fail").collect()
    with pytest.raises(ValueError):
        decode_json(df, "message string", on_error="skip")


def test_encode_json_keeps_field_order_and_nulls(spark):
    df = spark.createDataFrame([(5, "e", 2), (6, None, 1)], "windowStart bigint, region string, count bigint")
    got = encode_json(df, ["windowStart", "region"], ["count", "region"])
    assert rows_of(got, "key", "value") == [
        ('{"windowStart":5,"region":"e"}', '{"count":2,"region":"e"}'),
        ('{"windowStart":6,"region":null}', '{"count":1,"region":null}'),
    ]


def test_encode_window_key(spark):
    df = spark.createDataFrame([("i", AT)], "industry string, timestamp timestamp")
    counts = windowed_count(df, "industry", "1 hour").withColumn("value", F.lit("p\n"))
    assert counts.select(start_millis()).first()[0] == 1_704_067_200_000
    got = encode_window_key(counts, "industry")
    key = '{"windowStart":1704067200000,"windowEnd":1704070800000,"key":"i"}'
    assert rows_of(got, "key", "value") == [(key, "p\n")]


def test_avro_needs_its_package(spark):
    df = spark.createDataFrame([(bytearray(b"\x02a"),)], "value binary")
    with pytest.raises(RuntimeError, match="spark-avro"):
        decode_avro(df, '"string"', header_bytes=5).collect()


def test_print_table_prints_every_row(spark, tmp_path):
    place = str(tmp_path / "printed")

    def show(text):
        with open(place, "a") as file:
            file.write(text + "\n")

    df = spark.range(100).withColumn("key", F.lit(None).cast("string")).repartition(3)
    assert print_table(df, show=show) is None
    printed = Path(place).read_text().splitlines()
    assert sorted(printed) == sorted(f'{{"id":{i},"key":null}}' for i in range(100))


def test_broken_messages_of_a_topic(spark, tmp_path):
    settings = TopicSettings(root=str(tmp_path), encoded=True)
    messages = spark.createDataFrame([(str(i), t[0]) for i, t in enumerate(BAD_JSON)], "key string, value string")
    write_topic(messages, "m", settings)

    def read(**how):
        rows = read_topic(spark, "m", settings, "string", "message string", **how)
        return sorted(((r["key"], r["value"] and r["value"]["message"]) for r in rows.collect()), key=repr)

    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read()
    assert read(on_error="null") == [("0", None), ("1", "hi"), ("2", None)]
    assert read(on_error="drop") == [("1", "hi"), ("2", None)]
    with pytest.raises(ValueError):
        read(on_error="skip")
