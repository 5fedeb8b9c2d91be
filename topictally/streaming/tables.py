"""Aggregates over updating tables and streams, kept between micro-batches (AGG-4, UDF-4)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from topictally.functions.durations import interval, millis
from topictally.functions.windows import instant
from topictally.operators.aggregates import Fold, FoldParts
from topictally.operators.counts import key_columns
from topictally.sources.sinks import BatchSink
from topictally.streaming.carried import CarriedLog, CarriedState

#: The part of a group's result that an item's total makes, as a function of the total.
Measures = Mapping[str, Callable[[Column], Column]]


class _Windows:
    """Windows of an updating state: their bounds as columns, and which are still open."""

    def __init__(self, size: int | str | None, delay: int | str, time: str):
        self.size = None if size is None else millis(size)
        self.delay = millis(delay)
        self.time = time
        self.columns = [] if size is None else ["window_start_ms", "window_end_ms"]

    def add_to(self, df: DataFrame) -> DataFrame:
        if self.size is None:
            return df
        start = F.unix_millis(F.window(instant(df, self.time), interval(self.size)).start)
        rows = df.withColumn("window_start_ms", start)
        return rows.withColumn("window_end_ms", F.col("window_start_ms") + self.size)

    def still_open(self, state: CarriedState) -> Column | None:
        """Windows that end after the latest time of earlier batches less the delay."""
        latest = state.facts.get("latest")
        return None if latest is None else F.col("window_end_ms") > latest - self.delay

    def watch(self, rows: DataFrame, seen: Observation) -> DataFrame:
        """``rows`` with their latest time observed, if there are windows."""
        if self.size is None:
            return rows
        return rows.observe(seen, F.max(F.unix_millis(instant(rows, self.time))).alias("latest"))

    def latest(self, state: CarriedState, seen: Observation) -> dict:
        """What the next batch must know."""
        if self.size is None or not state.added:
            return {}
        return {"latest": max(seen.get["latest"], state.facts.get("latest") or seen.get["latest"])}


def updating_aggregate(
    df: DataFrame,
    by: str | Sequence[str],
    item: str,
    aggregate: Measures | Fold,
    sink: BatchSink,
    state_dir: str,
    increment: str | None = None,
    size: int | str | None = None,
    delay: int | str = "1 day",
    time: str = "timestamp",
) -> DataStreamWriter:
    """An aggregate over the item totals of each group of a stream, kept up to date as totals change.

    An item's total is its number of records, or the sum of ``increment``; at 0 the item is gone. A
    changed item is removed with its old total and added with the new one. ``aggregate`` names sums:
    for each, what an item with some total adds (and, removed, takes away again), as a column. All stays
    in the JVM then. A ``Fold`` with ``negate``, over the columns ``item`` and ``total``, does the same for
    aggregates that Spark lacks, on columns of many groups at once.

    With ``size`` groups are per window; records of windows that ended ``delay`` before the latest time
    of earlier batches are left out. Each micro-batch passes on one row per group with changed items:
    with a size ``window_start_ms`` and ``window_end_ms``, the group, ``version`` (higher is newer) and the
    result. Null is a group and an item like any other.

    Two logs (``CarriedLog``) lie in ``state_dir``: increments by group and item, so a hot group is in many
    buckets, and what the batches have added to their groups. A batch writes its changed items and
    groups only.
    """
    by = key_columns(by)
    windows = _Windows(size, delay, time)
    group = [*windows.columns, *by]
    value = F.lit(1) if increment is None else F.col(increment)
    shape = windows.add_to(df).select(*group, F.col(item).alias("_item")).schema
    items_schema = StructType([*shape, *StructType.fromDDL("_increment bigint")])
    items = CarriedLog(f"{state_dir}/items", items_schema, shape.names, lambda rows: totals(rows))

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*shape.names).agg(F.sum("_increment").alias("_increment"))

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known, seen = items.at(spark, batch_id), Observation()
        rows, still_open = windows.add_to(batch), windows.still_open(known)
        rows = windows.watch(rows if still_open is None else rows.filter(still_open), seen)
        known.append(
            totals(rows.select(*group, F.col(item).alias("_item"), value.cast("bigint").alias("_increment")))
        )
        # Only changed items are told; the others of their buckets drop out again.
        both = known.new().select("*", F.lit(True).alias("_new")).unionByName(
            known.before().select("*", F.lit(False).alias("_new"))
        )
        new = F.coalesce(F.sum("_increment"), F.lit(0)).alias("_total")
        old = F.coalesce(F.sum(F.when(~F.col("_new"), F.col("_increment"))), F.lit(0)).alias("_before")
        changes = both.groupBy(*shape.names).agg(new, old, F.bool_or("_new").alias("_new"))
        changes = changes.filter("_new").drop("_new")
        sums = _fold_sums if isinstance(aggregate, Fold) else _column_sums
        made, merge, finish = sums(changes, group, aggregate)
        log = CarriedLog(f"{state_dir}/groups", made.schema, group, merge)
        kept = log.at(spark, batch_id)
        kept.append(made)
        of = F.struct(*group).alias("_group")
        touched = kept.new().select(of)
        before = kept.before().withColumn("_group", of).join(touched, "_group", "left_semi")
        result = finish(merge(kept.new().unionByName(before.drop("_group"))))
        version = F.lit(batch_id + 1).cast("bigint").alias("version")
        sink(result.select(*group, version, *result.columns[len(group) :]), batch_id)
        known.commit(windows.latest(known, seen), still_open)
        kept.commit(keep=still_open)

    return df.writeStream.foreachBatch(work)


def _column_sums(changes: DataFrame, group: list[str], measures: Measures):
    """What changed items add to their groups, how to merge that, and the result."""

    def part(measure: Callable[[Column], Column], total: str) -> Column:
        there = F.col(total) != 0
        return F.coalesce(F.when(there, measure(F.col(total))), F.lit(0))

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*group).agg(*(F.sum(m).alias(m) for m in measures))

    changed = {m: (part(f, "_total") - part(f, "_before")).alias(m) for m, f in measures.items()}
    types = {f.name: f.dataType for f in changes.select(*changed.values()).schema}
    made = merge(changes.select(*group, *changed.values()))
    # Sums of decimals widen; the state keeps the type of a first sum.
    kept = {f.name: f.dataType for f in made.schema if f.name in types}

    def narrow(rows: DataFrame) -> DataFrame:
        return merge(rows).select(*group, *(F.col(m).cast(t).alias(m) for m, t in kept.items()))

    return made, narrow, lambda rows: rows


def _fold_sums(changes: DataFrame, group: list[str], aggregate: Fold):
    def rows_of(total: str) -> DataFrame:
        rows = changes.filter(F.col(total) != 0)
        return rows.select(*group, F.col("_item").alias("item"), F.col(total).alias("total"))

    parts = FoldParts(changes, group, aggregate)
    added = parts.start(rows_of("_total"))
    gone = parts.negate(parts.start(rows_of("_before")))
    # A group whose items are all gone has changed too.
    made = parts.by_group(parts.merge(added.unionByName(gone)))
    return made, lambda rows: parts.by_group(parts.merge(rows)), parts.finish


def fold_stream(
    df: DataFrame,
    by: str | Sequence[str],
    aggregate: Fold,
    sink: BatchSink,
    state_dir: str,
    size: int | str | None = None,
    delay: int | str = "1 day",
    time: str = "timestamp",
) -> DataStreamWriter:
    """``fold`` over the records of a stream: the newest result of each group with new records.

    A batch's states are merged inside tasks and appended to a log in ``state_dir`` (``CarriedLog``), as
    columns; no state is kept or called for group by group. Rows and windows are as in
    ``updating_aggregate``; ``aggregate`` needs no ``negate``.
    """
    by = key_columns(by)
    windows = _Windows(size, delay, time)
    group = [*windows.columns, *by]

    def work(batch: DataFrame, batch_id: int) -> None:
        rows = windows.add_to(batch)
        parts = FoldParts(rows, group, aggregate)
        log = CarriedLog(
            state_dir, parts.state_schema, group, lambda rows: parts.by_group(parts.merge(rows))
        )
        state = log.at(batch.sparkSession, batch_id)
        still_open = windows.still_open(state)
        seen = Observation()
        rows = windows.watch(rows if still_open is None else rows.filter(still_open), seen)
        state.append(parts.by_group(parts.merge(parts.start(rows))))
        of = F.struct(*group).alias("_group")
        touched = state.new().select(of)
        before = state.before().withColumn("_group", of).join(touched, "_group", "left_semi")
        result = parts.finish(parts.merge(state.new().unionByName(before.drop("_group"))))
        version = F.lit(batch_id + 1).cast("bigint").alias("version")
        sink(result.select(*group, version, *result.columns[len(group) :]), batch_id)
        state.commit(windows.latest(state, seen), still_open)

    return df.writeStream.foreachBatch(work)
