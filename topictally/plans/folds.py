"""Aggregates of one's own over page counts."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from topictally.operators.aggregates import Fold


class ViewDivisor(Fold):
    """Pages, and the greatest common divisor of their views."""

    state = "pages bigint, divisor bigint"
    result = "pages bigint, divisor bigint"

    def start(self, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pages": np.ones(len(rows), dtype=np.int64), "divisor": rows["n"]})

    def merge(self, states: pd.DataFrame, firsts: np.ndarray) -> pd.DataFrame:
        pages = np.add.reduceat(states["pages"].to_numpy(), firsts)
        return pd.DataFrame(
            {"pages": pages, "divisor": np.gcd.reduceat(states["divisor"].to_numpy(), firsts)}
        )


#: Items of a group and their total, as measures of ``updating_aggregate``.
ITEM_TOTALS = {"items": lambda total: F.lit(1).cast("bigint"), "total": lambda total: total}

#: A prime below the square root of what 64 bits hold, so that products stay exact.
PRIME = 2_147_483_647


class ItemProduct(Fold):
    """Items of a group, and the product of their totals modulo a prime, which can be taken back."""

    state = "items bigint, product bigint"
    result = "items bigint, product bigint"

    def start(self, rows: pd.DataFrame) -> pd.DataFrame:
        # Never 0, which has no inverse.
        factors = rows["total"].to_numpy(np.int64) % (PRIME - 1) + 1
        return pd.DataFrame({"items": np.ones(len(rows), dtype=np.int64), "product": factors})

    def merge(self, states: pd.DataFrame, firsts: np.ndarray) -> pd.DataFrame:
        products = states["product"].to_numpy(np.int64)
        sizes = np.diff(np.append(firsts, len(products)))
        group = np.repeat(np.arange(len(firsts)), sizes)
        # Neighbours of a group are multiplied until each group has one factor left.
        while len(products) > len(firsts):
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
            first = np.flatnonzero(place % 2 == 0)
            after = np.minimum(first + 1, len(group) - 1)
            paired = (after != first) & (group[after] == group[first])
            factor = np.where(paired, products[after], 1)
            products, group = products[first] * factor % PRIME, group[first]
        items = np.add.reduceat(states["items"].to_numpy(np.int64), firsts) if len(firsts) else []
        return pd.DataFrame({"items": items, "product": products})

    def negate(self, states: pd.DataFrame) -> pd.DataFrame:
        inverses = [pow(int(p), -1, PRIME) for p in states["product"]]
        return pd.DataFrame({"items": -states["items"], "product": np.array(inverses, dtype=np.int64)})
