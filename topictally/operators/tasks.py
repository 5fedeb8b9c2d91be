"""Combining rows inside a task, before any shuffle and without state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

HELD_ROWS = 200_000


def combine_in_task(
    df: DataFrame, combine: Callable[[pa.Table], pa.Table], held_rows: int = HELD_ROWS
) -> DataFrame:
    """Replace a task's rows by what ``combine`` makes of them, for streams too.

    ``combine`` gives fewer rows with the same columns, and may be applied to its own results. It
    runs whenever ``held_rows`` rows are held, so that its cost per row stays the same; rows it
    could not reduce to half of that are passed on. A task's memory is bounded by that number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            # Batches and results may differ in what they say about nulls, which forbids joining.
            schema = pa.schema([f.with_nullable(True) for f in batch.schema])
            held.append(pa.Table.from_batches([batch]).cast(schema))
            if sum(map(len, held)) >= held_rows:
                rows = combine(pa.concat_tables(held)).cast(schema)
                held = [rows]
                if len(rows) > held_rows // 2:
                    yield from rows.to_batches()
                    held = []
        if held:
            yield from combine(pa.concat_tables(held)).to_batches()

    return df.mapInArrow(run, df.schema)


def sum_in_task(df: DataFrame, increment: str) -> DataFrame:
    """Sum increments per otherwise equal row inside each task.

    A hot row then leaves a task a few times, not once per record.
    """
    fields = [c for c in df.columns if c != increment]

    def sums(rows: pa.Table) -> pa.Table:
        total = f"{increment}_sum"
        counted = rows.group_by(fields, use_threads=False).aggregate([(increment, "sum")])
        return counted.select([*fields, total]).rename_columns([*fields, increment])

    return combine_in_task(df.select(*fields, increment), sums)
