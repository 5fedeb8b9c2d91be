"""Topics made from the given tables, for trying the jobs without a broker.

Each takes a table (batch or streaming) and returns rows with the topic columns a job needs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from topictally.functions.windows import instant

from topictally.operators.counts import count_by_key
from topictally.session import Folder

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table ``events`` as a stream, be it one file or a folder of files."""
    # A stream reads a single file only if its path is a pattern.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/{{events.parquet}}")


SLICES = 5


def time_slices(events: DataFrame, folder: str, late: bool = False) -> Iterator[str]:
    """Folders of the events in ``SLICES`` parts of equal time, as they would arrive one after the other.

    All are written below ``folder`` at once. With ``late`` every 97th event comes one part after its
    time, and every 89th event of the first part comes in the last one.
    """
    micros = F.unix_micros(instant(events, "ts"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    if first is None:
        return
    place = F.call_function("div", (micros - first) * SLICES, F.lit(last - first + 1).cast("bigint"))
    if late:
        delayed = F.least(place + 1, F.lit(SLICES - 1))
        by_one = F.when(F.col("event_id") % 97 == 0, delayed).otherwise(place)
        place = F.when((F.col("event_id") % 89 == 0) & (place == 0), SLICES - 1).otherwise(by_one)
    events.withColumn("place", place.cast("int")).write.partitionBy("place").parquet(folder)
    written = Folder(events.sparkSession, folder)
    for i in range(SLICES):
        if written.sizes(f"place={i}"):
            yield f"place={i}"


def chat_messages(conversations: DataFrame) -> DataFrame:
    """Chat messages: key is the conversation, value a record with the field ``message``."""
    return conversations.select(
        F.col("conv_id").cast("string").alias("key"),
        F.struct(F.col("text").alias("message")).alias("value"),
    )


def region_records(events: DataFrame) -> DataFrame:
    """One region name per event."""
    return events.select(
        F.col("event_id").alias("key"),
        F.col("event_type").alias("value"),
        F.col("event_id").alias("offset"),
        instant(events, "ts").alias("timestamp"),
    )


def order_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region of each order, counted per customer before the joins: value, ``records``.

    A customer with a large share of all orders is one row in the join. No join is hinted; Spark
    broadcasts the tables below its size threshold, ``nation`` and ``region`` always among them.
    """
    orders = count_by_key(table(spark, sf_dir, "orders"), "o_custkey", name="records")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(places, customer.c_nationkey == places.n_nationkey)
        .select(F.col("r_name").alias("value"), "records")
    )


def page_views(events: DataFrame) -> DataFrame:
    """Page views with page, industry and flags; about half of them are articles."""
    score = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.concat(F.lit("page-"), (F.col("user_id") % 20).cast("string")).alias("page"),
        F.col("event_type").alias("industry"),
        F.when(score < 50, F.lit("ART")).otherwise(F.lit("AD")).alias("flags"),
        instant(events, "ts").alias("timestamp"),
    )
