"""Topics as tables and streams: reading, decoding, encoding, writing."""

from topictally.sources.codecs import (
    decode_avro,
    decode_column,
    decode_json,
    encode_column,
    encode_json,
    encode_window_key,
)
from topictally.sources.sinks import batch_writer, print_table, write_topic
from topictally.sources.topics import TopicSettings, read_table, read_topic

__all__ = [
    "TopicSettings",
    "batch_writer",
    "decode_avro",
    "decode_column",
    "decode_json",
    "encode_column",
    "encode_json",
    "encode_window_key",
    "print_table",
    "read_table",
    "read_topic",
    "write_topic",
]
