"""Top and last rows per group (TOP-1, TOP-2, LST-1). Batch input only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from topictally.functions.text import lines
from topictally.functions.windows import with_window_starts
from topictally.operators.counts import key_columns

#: Rows of one group that may meet in one task.
MET_ROWS = 100_000
GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def ranking_order(
    order: str | Column | Sequence[str | Column], descending: bool, ties: Sequence[str | Column]
) -> list[Column]:
    """Sort expressions: named columns follow ``descending``, given columns stay as they are."""
    items = [order] if isinstance(order, str | Column) else list(order)
    named = [
        (F.col(o).desc() if descending else F.col(o).asc()) if isinstance(o, str) else o
        for o in items
    ]
    return [*named, *(F.col(t).asc() if isinstance(t, str) else t for t in ties)]


def _spread(df: DataFrame, n: int) -> int:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return math.isqrt(tasks - 1) + 1 if n * tasks > MET_ROWS else 1


def top_n(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Column | Sequence[str | Column],
    n: int = 100,
    descending: bool = True,
    ties: Sequence[str | Column] = (),
    rank: str = "rank",
    spread: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank from 1.

    ``order`` names the measure, or gives sort expressions for an ordering of one's own; ``ties``
    decide between equal measures. ``descending=False`` gives the lowest first.

    Spark cuts each task's groups to ``n`` rows before the shuffle (``WindowGroupLimit``), so
    a hot group costs ``n`` rows per task. It does so up to a setting of the session, which is
    raised to ``n`` if it is lower; it changes no result.

    So that these do not all meet in one task, they are merged as a tree: the tasks' rows of a group
    first go to ``spread`` tasks, each of which passes ``n`` rows on. By default that is the square root of the
    number of shuffle partitions, where these would send more than ``MET_ROWS`` rows, and else 1.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    columns = df.columns
    df, by = with_window_starts(df, key_columns(by))
    ordering = ranking_order(order, descending, ties)
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT_CONF, "1000")):
        df.sparkSession.conf.set(GROUP_LIMIT_CONF, str(n))
    spread = _spread(df, n) if spread is None else spread
    if spread > 1:
        # Rows of one task stay together, so each part gets the rows of as many tasks.
        df = df.withColumn("_part", F.spark_partition_id() % spread)
        parts = Window.partitionBy(*by, "_part").orderBy(*ordering)
        df = df.withColumn(rank, F.row_number().over(parts)).filter(F.col(rank) <= n)
        df = df.drop(rank, "_part")
    whole = Window.partitionBy(*by).orderBy(*ordering)
    ranked = df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)
    return ranked.select(*columns, F.col(rank).cast("bigint").alias(rank))


def top_n_text(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Column | Sequence[str | Column],
    item: str,
    n: int = 100,
    descending: bool = True,
    ties: Sequence[str | Column] = (),
    name: str = "value",
) -> DataFrame:
    """The top items of each group as text, one per line (TOP-2).

    Only the ``n`` ranked rows of a group are collected; the grouping reuses the rank's shuffle.
    """
    by = key_columns(by)
    df, group = with_window_starts(df, by)
    ranked = top_n(df, group, order, n, descending, ties, rank="_rank")
    ordered = F.sort_array(F.collect_list(F.struct("_rank", F.col(item).alias("_item"))))
    items = F.transform(ordered, lambda row: row["_item"].cast("string"))
    windows = [c for c in by if c not in group]
    texts = ranked.groupBy(*group).agg(
        *(F.any_value(c).alias(c) for c in windows), lines(items).alias(name)
    )
    return texts.select(*by, name)


def last_n(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Sequence[str],
    n: int,
    ties: Sequence[str | Column] = (),
    rank: str = "rank",
) -> DataFrame:
    """The last ``n`` rows of each group, the newest ranked 1 (LST-1).

    ``ties`` decide between rows of one place in the order.
    """
    return top_n(df, by, order, n, descending=True, ties=ties, rank=rank)
