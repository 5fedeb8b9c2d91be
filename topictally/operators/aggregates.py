"""Aggregates of one's own (UDF-4, batch form). Use built-in aggregates where they will do."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from topictally.operators.counts import key_columns
from topictally.operators.tasks import combine_in_task

HELD_ROWS = 100_000


class Fold:
    """An aggregate over columns of many groups at once: start, merge and result.

    A row's state has the fields of ``state``, a group's result those of ``result`` (both DDL text).
    ``merge`` must not depend on the order of a group's states.
    """

    state: str
    result: str

    def start(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The state of each row on its own."""
        raise NotImplementedError

    def merge(self, states: pd.DataFrame, firsts: np.ndarray) -> pd.DataFrame:
        """One state per group; a group's states lie together, the first ones at ``firsts``."""
        raise NotImplementedError

    def negate(self, states: pd.DataFrame) -> pd.DataFrame:
        """The states that cancel these when merged. Needed only where rows are removed again."""
        raise NotImplementedError

    def finish(self, states: pd.DataFrame) -> pd.DataFrame:
        """The result of each group from its one state."""
        return states


def fold(
    df: DataFrame, by: str | Sequence[str], aggregate: Fold, held_rows: int = HELD_ROWS
) -> DataFrame:
    """Aggregate each group with ``aggregate``; only state rows are shuffled.

    Tasks merge the states of their own rows whenever ``held_rows`` are held, so their memory is
    bounded and a hot group leaves a task in few rows. After the shuffle one call merges the states
    of all groups that a hash puts together. Null is a value like any other in ``by``.
    """
    parts = FoldParts(df, by, aggregate, held_rows)
    return parts.finish(parts.merge(parts.start(df)))


class FoldParts:
    """The steps of ``fold`` on their own, for states that are kept. All work on many groups at once."""

    def __init__(
        self, df: DataFrame, by: str | Sequence[str], aggregate: Fold, held_rows: int = HELD_ROWS
    ):
        self.by = key_columns(by)
        self.aggregate = aggregate
        self.held_rows = held_rows
        group = df.select(*self.by).schema
        self.state_schema = StructType([*group, *StructType.fromDDL(aggregate.state)])
        self.result_schema = StructType([*group, *StructType.fromDDL(aggregate.result)])
        # Several parts for each task after the shuffle, so that each call's groups are few.
        self.parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def _table(self, keys: pa.Table, columns: pd.DataFrame, schema: StructType) -> pa.Table:
        wanted = to_arrow_schema(schema)
        arrays = [keys.column(c).combine_chunks() for c in self.by]
        names = schema.names[len(self.by) :]
        arrays += [pa.array(columns[n], wanted.field(n).type) for n in names]
        return pa.Table.from_arrays([a.cast(f.type) for a, f in zip(arrays, wanted)], schema=wanted)

    def _states(self, rows: pa.Table) -> pd.DataFrame:
        return rows.select(self.state_schema.names[len(self.by) :]).to_pandas()

    def _merged(self, rows: pa.Table) -> pa.Table:
        # Arrow-backed columns keep nulls and large whole numbers as they are.
        keys = rows.select(self.by).to_pandas(types_mapper=pd.ArrowDtype)
        codes = keys.groupby(self.by, dropna=False, sort=False).ngroup().to_numpy()
        places = np.argsort(codes, kind="stable")
        firsts = np.flatnonzero(np.diff(codes[places], prepend=-1))
        merged = self.aggregate.merge(self._states(rows.take(places)), firsts)
        return self._table(rows.take(places[firsts]), merged, self.state_schema)

    def _by_batch(self, df: DataFrame, columns_of, schema: StructType) -> DataFrame:
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    rows = pa.Table.from_batches([batch])
                    yield from self._table(rows, columns_of(rows), schema).to_batches()

        return df.mapInArrow(run, schema)

    def start(self, df: DataFrame) -> DataFrame:
        """A state for each row, merged inside tasks."""
        states = self._by_batch(df, lambda r: self.aggregate.start(r.to_pandas()), self.state_schema)
        return combine_in_task(states, self._merged, self.held_rows)

    def negate(self, states: DataFrame) -> DataFrame:
        return self._by_batch(states, lambda r: self.aggregate.negate(self._states(r)), self.state_schema)

    def merge(self, states: DataFrame) -> DataFrame:
        """One state for each group."""
        part = F.pmod(F.xxhash64(*self.by), F.lit(self.parts)).alias("_part")
        return states.groupBy(part).applyInArrow(lambda rows: self._merged(rows), self.state_schema)

    def by_group(self, merged: DataFrame) -> DataFrame:
        """Dealt by group, as tables of states are written."""
        return merged.repartition(*self.by)

    def finish(self, merged: DataFrame) -> DataFrame:
        return self._by_batch(merged, lambda r: self.aggregate.finish(self._states(r)), self.result_schema)
