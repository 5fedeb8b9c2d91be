"""Top and last rows per group of a stream (STR-6, LST-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from topictally.functions.durations import interval, millis
from topictally.operators.counts import key_columns, windowed_count
from topictally.operators.ranking import last_n, top_n
from topictally.sources.sinks import BatchSink
from topictally.streaming.carried import CarriedLog, CarriedState, Merge

#: Items kept in order for each list of lowest items, as a multiple of its length.
RESERVE = 4


def top_n_stream(
    df: DataFrame,
    by: str | Sequence[str],
    item: str,
    sink: BatchSink,
    n: int = 100,
    size: int | str = "1 hour",
    delay: int | str = "1 day",
    descending: bool = True,
    emit: str = "final",
    time: str = "timestamp",
    state_dir: str | None = None,
) -> DataStreamWriter:
    """The ``n`` items with most records per window and group, passed on to ``sink``.

    ``emit="final"``: each window once, after it closed. A closed window's counts all come in
    the same micro-batch, so ranking that batch's output by ``top_n`` is exact and holds no
    group's items in one place. Rows: ``window``, group, item, ``count``, ``rank``.

    ``emit="update"``: the new list of each group whose list changed, per micro-batch. Rows:
    ``window_start_ms``, ``window_end_ms``, group, ``version`` (higher is newer) and ``top``, an
    array of rank, item and count; see ``latest``. What is carried lies in ``state_dir`` as a log
    (``CarriedLog``), so a batch writes what changed. A null item is an item like others.

    Highest items: counts only grow, so an item outside a list can enter it only when its own count
    changes. The new lists are the top of the batch's changed counts and the lists before.

    Lowest items: an item that grows may leave the list to one that did not change. Each group keeps
    its lowest items in order, ``RESERVE`` times as many as the list is long, and a bound that no other
    item is below. A changed item moves in or out by its new count. Only when growth has emptied this
    reserve below ``n`` are all counts of the group read again, from the log of changed counts.
    """
    by = key_columns(by)
    if n < 1:
        raise ValueError("n must be at least 1")
    if emit not in ("final", "update"):
        raise ValueError(f"emit must be final or update, not {emit!r}")
    if emit == "update" and state_dir is None:
        raise ValueError("lists of open windows need a state_dir")
    rows = df.withColumn(item, F.col(item).cast("string"))
    counts = windowed_count(rows, [*by, item], size, delay=delay, time=time)
    if emit == "update":
        lists = _LiveLists(counts, by, item, sink, n, millis(size), millis(delay), state_dir)
        work = lists.highest if descending else lists.lowest
        return counts.writeStream.outputMode("update").foreachBatch(work)

    def rank_closed(closed: DataFrame, batch_id: int) -> None:
        ranked = top_n(closed, ["window", *by], "count", n, descending, ties=[item])
        sink(ranked, batch_id)

    return counts.writeStream.outputMode("append").foreachBatch(rank_closed)


def top_n_closed(
    df: DataFrame,
    by: str | Sequence[str],
    item: str,
    n: int = 100,
    size: int | str = "1 hour",
    delay: int | str = "1 day",
    descending: bool = True,
    time: str = "timestamp",
    spread: int | None = None,
) -> DataFrame:
    """The ``n`` items with most records per window and group, as a stream in append mode.

    One plan of three aggregations with state, so it has one checkpoint and any sink: counts per item,
    lists of the best items of each of ``spread`` parts of a group, and the lists' best. Each passes a window
    on once it has closed. A hot group's items are spread over as many parts as there are shuffle
    partitions, and each part sends ``n`` of them on. Columns: ``window``, the group, and ``top``, an array of
    rank, item and count, ties by item. A null item is an item like others.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    by = key_columns(by)
    spread = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn(item, F.col(item).cast("string"))
    counts = windowed_count(rows, [*by, item], size, delay=delay, time=time)
    order = -F.col("count") if descending else F.col("count")
    entry = F.struct(order.alias("order"), F.col(item).alias("item"))

    def again(windows: DataFrame, *more: Column):
        # The same window once more, now of the time at which it closes.
        window = F.window(F.window_time("window"), interval(size)).alias("window")
        return windows.groupBy(window, *by, *more)

    def best(entries: Column) -> Column:
        return F.slice(F.sort_array(entries), 1, n)

    part = F.pmod(F.hash(item), F.lit(spread)).alias("_part")
    parts = again(counts, part).agg(best(F.collect_list(entry)).alias("_top"))
    tops = again(parts).agg(best(F.flatten(F.collect_list("_top"))).alias("_top"))
    ranked = F.transform(
        "_top",
        lambda e, i: F.struct(
            (i + 1).cast("bigint").alias("rank"), e["item"].alias("item"), F.abs(e["order"]).alias("count")
        ),
    )
    return tops.select("window", *by, ranked.alias("top"))


class _LiveLists:
    """The work of a micro-batch of changed counts, for live lists."""

    def __init__(self, counts: DataFrame, by, item, sink, n, size_ms, delay_ms, state_dir):
        self.by, self.item, self.sink, self.n = by, item, sink, n
        self.size_ms, self.delay_ms, self.state_dir = size_ms, delay_ms, state_dir
        self.group = ["_start", *by]
        self.columns = [F.col("window.start").alias("_start"), *by, item, "count"]
        self.schema = counts.select(*self.columns).schema

    def ranked(self, rows: DataFrame, n: int, descending: bool) -> DataFrame:
        return top_n(rows, self.group, "count", n, descending, ties=[self.item])

    def newest(self, rows: DataFrame) -> DataFrame:
        """The newest count of each item: counts only grow."""
        return rows.groupBy(*self.group, self.item).agg(F.max("count").alias("count"))

    def log(self, name: str, merge: Merge, schema=None, parts: int | None = None) -> CarriedLog:
        """A log by group, in a folder of its own."""
        return CarriedLog(f"{self.state_dir}/{name}", schema or self.schema, self.group, merge, parts)

    def still_open(self, state: CarriedState) -> Column | None:
        # Late records are dropped by the watermark of the batch before, so windows are let go of
        # by what was known then. Window starts are never ahead of the records' times.
        known = state.facts.get("latest_start")
        if known is None:
            return None
        open_windows = F.unix_millis("_start") + self.size_ms > known - self.delay_ms
        return F.coalesce(open_windows, F.lit(True))

    def append(self, state: CarriedState, rows: DataFrame) -> dict:
        """Append a batch's counts; what the next batch must know of them."""
        newest = state.append(rows, start=F.max(F.unix_millis("_start")))["start"]
        known = [t for t in (state.facts.get("latest_start"), newest) if t is not None]
        return {"latest_start": max(known, default=None)}

    def tell(self, tops: DataFrame, batch_id: int) -> None:
        """Pass on the lists made of ranked rows of groups."""
        rows = F.struct("rank", F.col(self.item).alias("item"), "count")
        lists = tops.groupBy(*self.group).agg(F.sort_array(F.collect_list(rows)).alias("top"))
        self.tell_lists(lists, batch_id)

    def tell_lists(self, lists: DataFrame, batch_id: int) -> None:
        start = F.unix_millis("_start")
        told = lists.select(
            start.alias("window_start_ms"),
            (start + self.size_ms).alias("window_end_ms"),
            *self.by,
            F.lit(batch_id + 1).cast("bigint").alias("version"),
            "top",
        )
        self.sink(told, batch_id)

    def highest(self, changed: DataFrame, batch_id: int) -> None:
        log = self.log("tops", lambda rows: self.ranked(self.newest(rows), self.n, True))
        state = log.at(changed.sparkSession, batch_id)
        # Of a batch's changed items only its own top can be in a list. Computed once, as it updates counts.
        tops = self.ranked(changed.select(*self.columns), self.n, True).drop("rank")
        facts = self.append(state, tops)
        if batch_id and not state.added:  # nothing changed; Spark's own counts close windows then
            return state.commit()
        new = state.new().withColumn("_new", F.lit(True))
        both = new.unionByName(state.before().withColumn("_new", F.lit(False)))
        newest = both.groupBy(*self.group, self.item).agg(
            F.max("count").alias("count"), F.bool_or("_new").alias("_new")
        )
        tops = self.ranked(newest, self.n, True)
        changed_lists = tops.withColumn("_told", F.bool_or("_new").over(self.whole_group()))
        self.tell(changed_lists.filter("_told"), batch_id)
        state.commit(facts, self.still_open(state))

    def whole_group(self):
        return Window.partitionBy(*self.group)

    def lowest(self, changed: DataFrame, batch_id: int) -> None:
        spark, size = changed.sparkSession, RESERVE * self.n
        items = self.log("counts", self.newest).at(spark, batch_id)
        counts = changed.select(*self.columns)
        facts = self.append(items, counts.repartition(items.parts, *self.group))
        reserve = self.log("reserve", self._last_reserve, self.reserve_schema, items.parts)
        reserve = reserve.at(spark, batch_id)
        if batch_id and not items.added:
            items.commit()
            return reserve.commit()
        # Both logs are dealt by group into the same number of buckets.
        found = self._reserve(items.new(), reserve.before(items.added), size)
        number = F.lit(batch_id).cast("bigint").alias("_batch")
        told = reserve.append(found.select("*", number), short=F.count_if(self.is_short()))
        if told["short"]:
            self._refill(items, reserve, size, number)
        ranks = F.transform(
            F.slice("_items", 1, self.n),
            lambda e, i: F.struct(
                (i + 1).cast("bigint").alias("rank"), e["item"].alias("item"), e["count"].alias("count")
            ),
        )
        self.tell_lists(reserve.new().select(*self.group, ranks.alias("top")), batch_id)
        still_open = self.still_open(items)
        items.commit(facts, still_open)
        reserve.commit(keep=still_open)

    @property
    def entry(self) -> Column:
        return F.struct("count", F.col(self.item).alias("item"))

    @property
    def reserve_schema(self) -> StructType:
        """A group's lowest items in order, a bound that no other item is below, and the batch."""
        kind = {f.name: f for f in self.schema}
        entry = StructType([kind["count"], StructField("item", kind[self.item].dataType)])
        fields = [StructField("_items", ArrayType(entry)), StructField("_bound", entry)]
        return StructType([*(kind[g] for g in self.group), *fields, StructField("_batch", LongType())])

    def is_short(self) -> Column:
        return F.col("_bound").isNotNull() & (F.size("_items") < self.n)

    def _last_reserve(self, rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("_items", "_bound"), "_batch").alias("_last")
        rows = rows.groupBy(*self.group).agg(last, F.max("_batch").alias("_batch"))
        return rows.select(*self.group, "_last.*", "_batch")

    def _reserve(self, changed: DataFrame, old: DataFrame, size: int) -> DataFrame:
        """The new reserves of the changed groups: old and changed items below the old bounds."""
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.reserve_schema[-3:]]
        marks = changed.select(*self.group, *none, F.lit(True).alias("_new"))
        both = old.select("*", F.lit(False).alias("_new")).unionByName(marks)
        held = both.groupBy(*self.group).agg(
            F.max_by(F.struct("_items", "_bound"), "_batch").alias("_last"), F.bool_or("_new").alias("_new")
        )
        held = held.filter("_new").select(*self.group, "_last.*")

        def mark(entry: Column, is_bound: bool) -> Column:
            return F.struct(entry["count"].alias("count"), entry["item"].alias("item"), F.lit(is_bound).alias("edge"))

        bound = F.when(F.col("_bound").isNotNull(), F.array(mark(F.col("_bound"), True)))
        entries = F.concat(
            F.coalesce(F.transform("_items", lambda e: mark(e, False)), F.array()), F.coalesce(bound, F.array())
        )
        entries = held.select(*self.group, F.explode(entries).alias("_e"))
        rows = entries.select(
            *self.group, F.col("_e.item").alias(self.item), F.col("_e.count").alias("count"),
            F.col("_e.edge").alias("_edge"),
        ).unionByName(changed.withColumn("_edge", F.lit(False)))
        rows = rows.groupBy(*self.group, self.item, "_edge").agg(F.max("count").alias("count"))
        return self._cut(rows, size)

    def _cut(self, rows: DataFrame, size: int) -> DataFrame:
        """The lowest ``size`` items of each group up to its old bound, if it has one.

        A bound is a row with ``_edge``. What comes after it is not known in full and left out; where ``size``
        items come before it, the next one is the new bound.
        """
        ties = [self.item, "_edge"]
        ranked = top_n(rows, self.group, "count", size + 1, descending=False, ties=ties)
        before = Window.partitionBy(*self.group).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
        ranked = ranked.withColumn("_beyond", F.bool_or("_edge").over(before))
        ranked = ranked.filter(~F.coalesce("_beyond", F.lit(False)))
        edge = F.col("_edge") | (F.col("rank") > size)
        return ranked.groupBy(*self.group).agg(
            F.sort_array(F.collect_list(F.when(~edge, self.entry))).alias("_items"),
            F.max(F.when(edge, self.entry)).alias("_bound"),
        )

    def _refill(self, items: CarriedState, reserve: CarriedState, size: int, number: Column) -> None:
        """Take the reserves that have run short from all counts of their groups."""
        of = F.struct(*self.group).alias("_group")
        found = reserve.new()
        short = found.filter(self.is_short()).select(of)
        whole = items.new().unionByName(items.before()).withColumn("_group", of)
        whole = self.newest(whole.join(short, "_group", "left_semi")).withColumn("_edge", F.lit(False))
        again = self._cut(whole, size).select("*", number)
        both = found.filter(~self.is_short()).unionByName(again)
        reserve.replace(both.repartition(reserve.parts, *self.group))


def last_n_stream(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Sequence[str],
    sink: BatchSink,
    n: int,
    state_dir: str,
) -> DataStreamWriter:
    """The last ``n`` rows of each key of a stream, the newest ranked 1, passed on to ``sink``.

    Each micro-batch gives one row per key whose list changed: the key, ``version`` (higher is newer)
    and ``last``, an array of rank and the other columns. The new lists are the last rows of the
    micro-batch and of the lists before. A batch appends its own last rows to a log in ``state_dir``
    (``CarriedLog``); tasks cut rows to ``n`` per key before the shuffle. Rows without a place in the
    order are oldest, rows of one place go by their other columns, null is a key like any other, and
    repeated rows are rows of their own.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    by, order = key_columns(by), key_columns(order)
    fields = [c for c in df.columns if c not in by]
    if missing := [o for o in order if o not in fields]:
        raise ValueError(f"no such column to order by: {missing}")
    # Maps have no order.
    comparable = [c for c in fields if "map<" not in df.schema[c].dataType.simpleString()]
    ties = [F.col(c).desc() for c in comparable if c not in order]

    def last(rows: DataFrame) -> DataFrame:
        return last_n(rows, by, order, n, ties=ties, rank="_rank")

    log = CarriedLog(state_dir, df.schema, by, lambda rows: last(rows).drop("_rank"))

    def rank_last(batch: DataFrame, batch_id: int) -> None:
        state = log.at(batch.sparkSession, batch_id)
        state.append(last(batch))
        new = state.new().withColumn("_new", F.lit(True))
        both = last(new.unionByName(state.before().withColumn("_new", F.lit(False))))
        row = F.struct(F.col("_rank").alias("rank"), *fields)
        lists = both.groupBy(*by).agg(
            F.bool_or("_new").alias("_new"), F.collect_list(row).alias("_rows")
        )
        ranked = F.array_sort("_rows", lambda a, b: (a["rank"] - b["rank"]).cast("int"))
        version = F.lit(batch_id + 1).cast("bigint").alias("version")
        sink(lists.filter("_new").select(*by, version, ranked.alias("last")), batch_id)
        state.commit()

    return df.writeStream.outputMode("append").foreachBatch(rank_last)


def latest(df: DataFrame, by: str | Sequence[str], rows: str) -> DataFrame:
    """The newest version of each group's array ``rows``, one row per element. Batch input.

    Versions are compared map-side, so each task sends one array per group.
    """
    by = key_columns(by)
    newest = df.groupBy(*by).agg(F.max_by(rows, "version").alias("_rows"))
    return newest.select(*by, F.inline("_rows"))
