"""Column expressions."""

from topictally.functions.durations import millis
from topictally.functions.text import is_article, lines, lower_words, split_words
from topictally.functions.windows import end_millis, start_millis

__all__ = [
    "end_millis",
    "is_article",
    "lines",
    "lower_words",
    "millis",
    "split_words",
    "start_millis",
]
