"""Topics of updates as the tables they stand for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from topictally.operators.counts import key_columns


def newest(
    df: DataFrame,
    key: str | Sequence[str] = "key",
    value: str = "value",
    order: str | Sequence[str] = "batch",
    keep_removed: bool = False,
) -> DataFrame:
    """The table that an update topic stands for: the last value of each key. Batch input.

    ``order`` names what tells later updates: the micro-batch of a file topic, the offset of a broker's (a
    key's updates lie in one partition). A last value of null removes its key, unless ``keep_removed``. Null
    is a key like any other. An update that was written twice changes nothing; of different values at
    the same place the greater one holds. Tasks keep one update per key before the shuffle, so neither a
    hot key nor many updates of one meet in a task.
    """
    key, order = key_columns(key), key_columns(order)
    last = F.max(F.struct(*order, F.col(value).alias("_value"))).alias("_last")
    table = df.groupBy(*key).agg(last).select(*key, F.col("_last._value").alias(value))
    return table if keep_removed else table.filter(F.col(value).isNotNull())
