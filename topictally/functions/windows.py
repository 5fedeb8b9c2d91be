"""Accessors of a window column (FN-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType

from topictally.functions.durations import millis


def instant(df: DataFrame, time: str) -> Column:
    """The time column as an instant; zone-less times are UTC, whatever zone the session has."""
    if not isinstance(df.schema[time].dataType, TimestampNTZType):
        return F.col(time)
    since = F.col(time) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    # A difference of zone-less times is exact; any cast of the time itself would use the session's zone.
    seconds = since.cast("interval second").cast("decimal(18,6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))


def with_instant(df: DataFrame, time: str) -> DataFrame:
    """``df`` with its time column as an instant."""
    if not isinstance(df.schema[time].dataType, TimestampNTZType):
        return df
    return df.withColumn(time, instant(df, time))


def start_millis(window: str = "window") -> Column:
    """Window start in epoch milliseconds."""
    return F.unix_millis(F.col(f"{window}.start"))


def end_millis(window: str = "window") -> Column:
    """Window end (exclusive) in epoch milliseconds."""
    return F.unix_millis(F.col(f"{window}.end"))


def window_from(start: Column, size: int | str) -> Column:
    """The window of a size that starts at ``start``, as ``F.window`` gives it."""
    end = F.timestamp_micros(F.unix_micros(start) + F.lit(millis(size) * 1000))
    return F.struct(start.alias("start"), end.alias("end"))


def with_window_starts(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Columns to group or sort by instead of ``by``: a window's start for the whole window.

    Windows of one size are as distinct as their starts, and a plain timestamp sorts faster.
    """
    columns = []
    for name in by:
        if getattr(df.schema[name].dataType, "names", None) == ["start", "end"]:
            df = df.withColumn(f"_{name}_start", F.col(f"{name}.start"))
            name = f"_{name}_start"
        columns.append(name)
    return df, columns
