"""Change streams: a counting table as the sequence of its updates (STR-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from topictally.functions.durations import interval
from topictally.functions.windows import instant, window_from
from topictally.operators.counts import drop_null_key, key_columns

def with_window(df: DataFrame, size: int | str | None, time: str) -> DataFrame:
    """Add the tumbling ``window`` column if a size is given."""
    if size is None:
        return df
    return df.withColumn("window", F.window(instant(df, time), interval(size)))


def block_bounds(order: str, blocks: int) -> Column:
    """An aggregate: the places in the order that part the records into ``blocks`` of about equal rows."""
    shares = [i / blocks for i in range(1, blocks)] or [1.0]
    return F.percentile_approx(F.col(order).cast("bigint"), shares, 20 * blocks)


def block_number(order: str, blocks: int, bounds: Column) -> Column:
    """Number of the block a record falls into: how many of the bounds are not above its place."""
    place = F.col(order).cast("bigint")
    steps = [1 << i for i in range((blocks - 1).bit_length() - 1, -1, -1)]

    def step(found: Column, size: Column) -> Column:
        beyond = F.get(bounds, found + size - 1) <= place
        return F.when(F.coalesce(beyond, F.lit(False)), found + size).otherwise(found)

    number = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if steps else F.lit(0)
    missing = F.raise_error(F.lit(f"{order} is null; records without a place have no order"))
    return F.when(place.isNull(), missing.cast("int")).otherwise(number)


def changelog(
    df: DataFrame,
    key: str | Sequence[str] = "key",
    order: str | Sequence[str] = "offset",
    size: int | str | None = None,
    time: str = "timestamp",
    blocks: int | None = None,
    keep_null_key: bool = False,
    carried: DataFrame | None = None,
    bounds: Sequence[int] | None = None,
    name: str = "count",
) -> DataFrame:
    """Every update of a count as a row: one row per record with its key's count so far.

    With ``size`` the count is per key and window. The first ``order`` column is a whole number
    such as the offset, unique in its topic partition; add ``"partition"`` for topics of several
    partitions. Batch input only; see ``streaming.stream_changelog`` for streams.

    No key is numbered in one task: the order is cut into ``blocks`` of about equal rows, by default as
    many as shuffle partitions, wherever the offsets lie. Records are numbered inside (key, block);
    the counts of a key's earlier blocks, summed from the counted blocks, are added. Records cross
    the network once; before that their offsets are read for the cuts, and keys and offsets for the
    blocks' counts.

    ``carried`` holds counts from before this input, as key columns and ``_carried``. ``bounds`` are cuts that
    were found before (``block_bounds``); the offsets are then not read for them.
    """
    if blocks is None:
        blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if blocks < 1:
        raise ValueError("blocks must be at least 1")
    order = key_columns(order)
    fields = key_columns(key)
    rows = drop_null_key(df, key, keep_null_key)
    if bounds is None:
        cuts = rows.agg(block_bounds(order[0], blocks).alias("bounds")).scalar()
    else:
        cuts = F.expr(f"cast(array({', '.join(f'{b}L' for b in bounds)}) AS array<bigint>)")
    rows = rows.withColumn("_bounds", cuts)
    # Struct equality takes null fields as equal, as grouping does; plain columns would not join,
    # but sort and hash faster, so a single key without nulls stays a plain column.
    plain = isinstance(key, str) and not keep_null_key
    group = F.col(fields[0]) if plain else F.struct(*fields)
    parts = {"_key": group, "_block": block_number(order[0], blocks, F.col("_bounds"))}
    if size is not None:
        parts = {"_start": F.window(instant(df, time), interval(size)).start, **parts}
    others = [c for c in df.columns if c not in fields]
    rows = rows.select(*(c.alias(n) for n, c in parts.items()), *others)
    cell, keyed = list(parts), [p for p in parts if p != "_block"]

    earlier = Window.partitionBy(*keyed).orderBy("_block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_records").over(earlier), F.lit(0))
    counted = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_records"))
    counted = counted.select(*cell, before.alias("_before"))
    if carried is not None:
        start = [F.col("window.start").alias("_start")] if size is not None else []
        past = carried.select(*start, group.alias("_key"), "_carried")
        before = F.col("_before") + F.coalesce("_carried", F.lit(0))
        counted = counted.join(past, keyed, "left").select(*cell, before.alias("_before"))

    inside = Window.partitionBy(*cell).orderBy(*order)
    numbered = rows.withColumn("_number", F.row_number().over(inside).cast("bigint"))
    window = [] if size is None else [window_from(F.col("_start"), size).alias("window")]
    restored = ["_key"] if plain else [f"_key.{f}" for f in fields]
    return numbered.join(counted, cell, "left").select(
        *window,
        *(F.col(c).alias(f) for c, f in zip(restored, fields)),
        *others,
        (F.col("_before") + F.col("_number")).alias(name),
    )
