"""Row-wise operators: re-keying, filtering, flattening. None of them shuffles.

Expressions are columns, column names, or functions of the current value column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from topictally.functions.windows import start_millis

Expression = Column | str | Callable[[Column], Column]


def _resolve(expr: Expression, value: str) -> Column:
    if isinstance(expr, str):
        return F.col(expr)
    return expr(F.col(value)) if callable(expr) and not isinstance(expr, Column) else expr


def rekey(
    df: DataFrame,
    expr: Expression = "value",
    all_columns: bool | Sequence[str] = False,
) -> DataFrame:
    """Replace the key (PRJ-1). ``all_columns`` makes the whole record the key (PRJ-2):

    ``True`` takes every column but the present key, a list takes the ones named.
    """
    if all_columns:
        fields = [c for c in df.columns if c != "key"] if all_columns is True else all_columns
        return df.withColumn("key", F.struct(*fields))
    return df.withColumn("key", _resolve(expr, "value"))


def keep(df: DataFrame, predicate: Expression) -> DataFrame:
    """Rows where the predicate is true (FLT-1); a null predicate does not keep a row."""
    return df.filter(_resolve(predicate, "value"))


def map_values(df: DataFrame, expr: Expression, value: str = "value") -> DataFrame:
    """Transform the value, keep the key (PRJ-4)."""
    return df.withColumn(value, _resolve(expr, value))


def flat_map_values(df: DataFrame, array: Expression, value: str = "value") -> DataFrame:
    """One row per element of the array, all other columns kept (GEN-1)."""
    return df.withColumn(value, F.explode(_resolve(array, value)))


def flatten_window(
    df: DataFrame, start_col: str = "windowStart", window: str = "window"
) -> DataFrame:
    """Replace the window by its start in epoch milliseconds (PRJ-3)."""
    others = [F.col(c) for c in df.columns if c != window]
    return df.select(start_millis(window).alias(start_col), *others)


def regroup(
    df: DataFrame,
    by: str | Sequence[str],
    fields: Mapping[str, Expression] | None = None,
    window: str | None = "window",
) -> DataFrame:
    """Re-key a windowed table by some of its fields and keep its window (PRJ-5).

    ``fields`` builds the new record from fields and constants (PRJ-6); without it all other
    columns stay. Group the result with ``groupBy``, ``top_n`` or ``fold`` (AGG-4).
    """
    by = [by] if isinstance(by, str) else list(by)
    group = [*([window] if window else []), *by]
    if fields is None:
        fields = {c: c for c in df.columns if c not in group}
    new = [
        _resolve(expr, "value").alias(name) for name, expr in fields.items() if name not in group
    ]
    return df.select(*group, *new)
