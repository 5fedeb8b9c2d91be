"""Change streams with one row per record (STR-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from topictally.functions.durations import millis
from topictally.functions.windows import with_instant
from topictally.operators.changes import block_bounds, changelog, with_window
from topictally.operators.counts import drop_null_key, key_columns
from topictally.sources.sinks import BatchSink
from topictally.streaming.carried import CarriedLog


def stream_changelog(
    df: DataFrame,
    sink: BatchSink,
    state_dir: str,
    key: str | Sequence[str] = "key",
    order: str | Sequence[str] = "offset",
    size: int | str | None = None,
    delay: int | str = "1 day",
    time: str = "timestamp",
    blocks: int | None = None,
    hold: bool = False,
    keep_null_key: bool = False,
    name: str = "count",
) -> DataStreamWriter:
    """One row per record of a stream with its key's count so far, passed on to ``sink``.

    (For one row per key and micro-batch, run ``count_by_key`` or ``windowed_count`` in
    ``update`` mode.) Each micro-batch is numbered by ``changelog``, so a hot key is spread over
    tasks, on top of the counts carried from the batches before. Those are a log of the batches' own
    counts (``CarriedLog``): a batch writes a row for each of its keys and reads the buckets they fall
    into. With ``size`` only windows that may still get records are held, and records of closed
    windows are left out: windows that end at or before the latest time of earlier batches less ``delay``.

    A micro-batch is read several times, mostly a few columns of it. ``hold`` keeps it in memory or
    on local disk instead, for brokers, where reading is dear and batches are limited in size.
    """
    fields = [*(["window"] if size is not None else []), *key_columns(key)]
    key_schema = with_window(df, size, time).select(*fields).schema
    schema = StructType([*key_schema, StructField("_carried", LongType())])

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*fields).agg(F.sum("_carried").alias("_carried"))

    log = CarriedLog(state_dir, schema, fields, totals)

    def number_held_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            number_batch(batch, batch_id)
        finally:
            batch.unpersist()

    def number_batch(batch: DataFrame, batch_id: int) -> None:
        state = log.at(batch.sparkSession, batch_id)
        rows = drop_null_key(with_instant(batch, time) if size is not None else batch, key, keep_null_key)
        open_windows, latest = None, state.facts.get("latest")
        if latest is not None:
            open_windows = F.unix_micros(F.col("window.end")) > latest - millis(delay) * 1000
            rows = with_window(rows, size, time).filter(open_windows).drop("window")
        parts = blocks or int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        told, seen = [block_bounds(key_columns(order)[0], parts).alias("bounds")], Observation()
        if size is not None:
            told.append(F.max(F.unix_micros(time)).alias("latest"))
        # Counting the batch also finds the cuts of its order and its latest time.
        counted = with_window(rows.observe(seen, *told), size, time).groupBy(*fields)
        state.append(counted.agg(F.count(F.lit(1)).alias("_carried")))
        past = totals(state.before()) if state.chains else None
        found = seen.get if state.added else {"bounds": []}
        bounds = found["bounds"]
        changes = changelog(rows, key, order, size, time, parts, keep_null_key, past, bounds, name)
        sink(changes, batch_id)
        if found.get("latest") is not None:
            latest = max(found["latest"], latest or found["latest"])
        state.commit({"latest": latest}, open_windows)

    return df.writeStream.foreachBatch(number_held_batch if hold else number_batch)
