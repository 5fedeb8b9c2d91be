"""Values as bytes or JSON text and back (SRC-4, SRC-5, SNK-2, SNK-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from topictally.session import Folder

BAD_RECORD = "_bad_record"


def as_type(value: DataType | str) -> DataType:
    return DataType.fromDDL(value) if isinstance(value, str) else value


def decode_column(column: Column, data_type: DataType | str, on_error: str = "fail") -> Column:
    """Bytes of a topic as a typed column: UTF-8 text, 8-byte big-endian long, or JSON record.

    A broken JSON record ends the query (``on_error="fail"``) or gives null fields (``"null"``).
    """
    data_type = as_type(data_type)
    if isinstance(data_type, BinaryType):
        return column
    if isinstance(data_type, StringType):
        return column.cast("string")
    if isinstance(data_type, LongType):
        # A negative target base makes conv read the 16 hex digits as a signed number.
        return F.conv(F.hex(column), 16, -10).cast("bigint")
    if isinstance(data_type, StructType):
        mode = {"fail": "FAILFAST", "null": "PERMISSIVE"}[on_error]
        return F.from_json(column.cast("string"), data_type, {"mode": mode})
    raise ValueError(f"no topic encoding for {data_type.simpleString()}")


def encode_column(column: Column, data_type: DataType | str) -> Column:
    """The reverse of ``decode_column``."""
    data_type = as_type(data_type)
    if isinstance(data_type, BinaryType):
        return column
    if isinstance(data_type, StringType):
        return column.cast("binary")
    if isinstance(data_type, LongType):
        return F.unhex(F.lpad(F.hex(column), 16, "0"))
    if isinstance(data_type, StructType):
        return json_text(column).cast("binary")
    raise ValueError(f"no topic encoding for {data_type.simpleString()}")


def json_text(record: Column) -> Column:
    """A record as JSON, null fields included, fields in the record's order."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def decode_json(
    df: DataFrame,
    schema: StructType | str,
    column: str = "value",
    on_error: str = "null",
) -> DataFrame:
    """Replace JSON text by the record it holds (SRC-4).

    A broken record gives null fields (``on_error="null"``), ends the query (``"fail"``) or is
    left out (``"drop"``). A missing field is null and not an error.
    """
    schema = as_type(schema)
    if on_error == "null":
        return df.withColumn(column, F.from_json(column, schema))
    if on_error == "fail":
        return df.withColumn(column, F.from_json(column, schema, {"mode": "FAILFAST"}))
    if on_error != "drop":
        raise ValueError(f"on_error must be null, fail or drop, not {on_error!r}")
    marked = StructType([*schema.fields, StructField(BAD_RECORD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    parsed = df.withColumn(column, F.from_json(column, marked, options))
    good = parsed.filter(F.col(f"{column}.{BAD_RECORD}").isNull())
    return good.withColumn(column, F.col(column).dropFields(BAD_RECORD))


def schema_text(spark: SparkSession, schema: str) -> str:
    """An Avro schema that is given as JSON text, or as the path of a file that Spark can read."""
    if schema.lstrip().startswith(("{", "[", '"')):
        return schema
    folder, _, name = schema.rpartition("/")
    text = Folder(spark, folder or ".").read_text(name)
    if text is None:
        raise FileNotFoundError(f"no schema file {schema}")
    return text


def decode_avro(
    df: DataFrame, schema_json: str, column: str = "value", header_bytes: int = 0
) -> DataFrame:
    """Replace Avro bytes by the record they hold (SRC-5); needs the ``spark-avro`` package.

    ``header_bytes`` skips a prefix before the record, such as 5 bytes with a registry's id.
    """
    from pyspark.sql.avro.functions import from_avro

    payload = F.col(column)
    if header_bytes:
        payload = F.substr(payload, F.lit(header_bytes + 1))
    try:
        return df.withColumn(column, from_avro(payload, schema_json))
    except (AnalysisException, TypeError) as error:
        if "AVRO" not in str(error) and not isinstance(error, TypeError):
            raise
        raise RuntimeError("decoding Avro needs the spark-avro package on the session") from error


def encode_json(
    df: DataFrame, key_cols: Sequence[str], value_cols: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Columns as JSON key and JSON value (SNK-2); columns in ``keep`` are passed on."""
    return df.select(
        json_text(F.struct(*key_cols)).alias("key"),
        json_text(F.struct(*value_cols)).alias("value"),
        *keep,
    )


def encode_window_key(
    df: DataFrame, key: str, value: str = "value", window: str = "window"
) -> DataFrame:
    """A windowed key as JSON with the window's bounds in epoch milliseconds (SNK-3)."""
    record = F.struct(
        F.unix_millis(F.col(f"{window}.start")).alias("windowStart"),
        F.unix_millis(F.col(f"{window}.end")).alias("windowEnd"),
        F.col(key).alias("key"),
    )
    return df.select(json_text(record).alias("key"), F.col(value).alias("value"))
