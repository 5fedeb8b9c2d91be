from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of

from topictally.operators import Fold, fold


class Span(Fold):
    state = "rows bigint, low bigint, high bigint"
    result = "rows bigint, span bigint"

    def start(self, rows):
        return pd.DataFrame({"rows": 1, "low": rows["n"], "high": rows["n"]})

    def merge(self, states, firsts):
        reduced = zip(states.columns, (np.add, np.minimum, np.maximum))
        return pd.DataFrame({c: f.reduceat(states[c].to_numpy(), firsts) for c, f in reduced})

    def finish(self, states):
        return pd.DataFrame({"rows": states["rows"], "span": states["high"] - states["low"]})


@pytest.mark.parametrize("held_rows", [1, 2, 1000])
def test_fold_against_brute_force(spark, held_rows):
    # Keys that a float could not tell apart, and a null key.
    keys = [2**53, 2**53 + 1, None, 7]
    rows = [(keys[i % 7 % 4], i * i) for i in range(200)]
    groups = defaultdict(list)
    for key, n in rows:
        groups[key].append(n)
    df = spark.createDataFrame(rows, "key bigint, n bigint").repartition(5)
    got = {r.key: (r.rows, r.span) for r in fold(df, "key", Span(), held_rows).collect()}
    assert got == {k: (len(v), max(v) - min(v)) for k, v in groups.items()}


def test_fold_by_several_columns(spark):
    df = spark.sql(
        "SELECT timestamp_seconds(id % 2) AS t, cast(id % 3 AS string) AS s, id AS n FROM range(60)"
    )
    got = fold(df, ["t", "s"], Span())
    assert got.columns == ["t", "s", "rows", "span"]
    assert {tuple(r) for r in got.select("rows", "span").collect()} == {(10, 54)}
    assert got.join(df.select("t", "s").distinct(), ["t", "s"]).count() == 6


def test_fold_of_nothing(spark):
    df = spark.createDataFrame([], "key bigint, n bigint")
    assert rows_of(fold(df, "key", Span()), "key") == []
