"""Counts per key (AGG-1 to AGG-3).

Spark counts map-side first, so a hot key sends one partial row per task over the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from topictally.functions.durations import interval, millis
from topictally.functions.windows import window_from, with_instant
from topictally.operators.tasks import sum_in_task


#: Windows a record may be copied to before the shuffle, rather than counted per pane in one of its own.
OVERLAP = 4


def key_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def drop_null_key(df: DataFrame, key: str | Sequence[str], keep_null_key: bool) -> DataFrame:
    """Drop null keys. A key of several fields is a record, which itself is never null."""
    if keep_null_key or not isinstance(key, str):
        return df
    return df.filter(F.col(key).isNotNull())


def _measure(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(F.col(weight).cast("bigint"))


def count_by_key(
    df: DataFrame,
    key: str | Sequence[str] = "key",
    weight: str | None = None,
    keep_null_key: bool = False,
    name: str = "count",
) -> DataFrame:
    """Count of records per key over all time (AGG-1).

    ``weight`` names a column with the number of records a row stands for, for input that was
    partly counted before. As a stream the result runs in ``complete`` or ``update`` mode.
    """
    rows = drop_null_key(df, key, keep_null_key)
    return rows.groupBy(*key_columns(key)).agg(_measure(weight).alias(name))


def windowed_count(
    df: DataFrame,
    key: str | Sequence[str] = "key",
    size: int | str = "1 minute",
    advance: int | str | None = None,
    delay: int | str | None = "1 day",
    time: str = "timestamp",
    weight: str | None = None,
    keep_null_key: bool = False,
    name: str = "count",
) -> DataFrame:
    """Count of records per key and event-time window (AGG-2, AGG-3).

    Windows are half-open and aligned to the epoch; ``advance`` defaults to ``size`` (tumbling).
    ``delay`` is how late a record of a stream may come; ``None`` leaves a watermark set
    before. Columns: ``window``, the key columns, the count.

    Hopping windows that overlap ``OVERLAP`` times or less copy each record to its windows inside the
    task that counts them, so there is one shuffle. Beyond that, where ``advance`` divides ``size``, records
    are counted per pane of one advance first, and only the pane counts are copied to their windows. In
    a stream tasks count panes before the shuffle at any overlap, and a record's lateness is that of its
    pane: a window closes at most one advance later.
    """
    keys = key_columns(key)
    size_ms = millis(size)
    advance_ms = size_ms if advance is None else millis(advance)
    if not 0 < advance_ms <= size_ms:
        raise ValueError(f"advance must be above 0 and at most the size, got {advance!r}")
    rows = drop_null_key(df, key, keep_null_key)
    rows = with_instant(rows, time)
    window = F.window(time, interval(size_ms), interval(advance_ms))
    panes = advance_ms < size_ms and size_ms % advance_ms == 0
    pane = F.window(time, interval(advance_ms)).start.alias(time)
    if df.isStreaming:
        if panes and delay is not None:
            value = F.lit(1) if weight is None else F.col(weight)
            rows = rows.select(pane, *keys, value.cast("bigint").alias("_records"))
            rows, weight = sum_in_task(rows, "_records"), "_records"
        if delay is not None:
            rows = rows.withWatermark(time, interval(delay))
        return rows.groupBy(window.alias("window"), *keys).agg(_measure(weight).alias(name))
    if panes and size_ms > OVERLAP * advance_ms:
        rows = rows.groupBy(pane, *keys).agg(_measure(weight).alias("_records"))
        weight = "_records"
    # Plain timestamps as keys stay in Spark's fast aggregation path; a window struct would not.
    counts = rows.groupBy(window.start.alias("_start"), *keys).agg(_measure(weight).alias(name))
    return counts.select(window_from(F.col("_start"), size_ms).alias("window"), *keys, name)
