"""DataFrame operators, for batch and (unless said otherwise) streaming input."""

from topictally.operators.aggregates import Fold, fold
from topictally.operators.changes import changelog
from topictally.operators.counts import count_by_key, windowed_count
from topictally.operators.ranking import last_n, top_n, top_n_text
from topictally.operators.rows import (
    flat_map_values,
    flatten_window,
    keep,
    map_values,
    regroup,
    rekey,
)
from topictally.operators.tables import newest

__all__ = [
    "Fold",
    "changelog",
    "count_by_key",
    "flat_map_values",
    "flatten_window",
    "fold",
    "keep",
    "last_n",
    "map_values",
    "newest",
    "regroup",
    "rekey",
    "top_n",
    "top_n_text",
    "windowed_count",
]
