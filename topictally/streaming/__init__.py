"""Streaming jobs and the operators that need state beyond Spark's aggregations."""

from topictally.streaming.changes import stream_changelog
from topictally.streaming.jobs import Job
from topictally.streaming.ranking import last_n_stream, latest, top_n_closed, top_n_stream
from topictally.streaming.tables import fold_stream, updating_aggregate

__all__ = [
    "Job",
    "fold_stream",
    "last_n_stream",
    "latest",
    "stream_changelog",
    "top_n_closed",
    "top_n_stream",
    "updating_aggregate",
]
