"""How texts get to Python workers, and what a worker keeps from one task to the next."""

from __future__ import annotations

import ctypes
import inspect
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import SparkSession

STORE = "_topictally_worker"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Texts in a batch; Spark's own number would make tens of megabytes of them.
BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session send at most ``BATCH`` rows to a worker at once; it changes no result."""
    if int(spark.conf.get(BATCH_CONF)) > BATCH:
        spark.conf.set(BATCH_CONF, str(BATCH))


def kept_by_worker(name: str, make: Callable[[], object]) -> object:
    """``make()`` of the first call with this name in the process.

    Functions of this package reach workers by value, so their own globals are new in each task.
    """
    store = vars(sys.modules.setdefault(STORE, ModuleType(STORE)))
    if name not in store:
        store[name] = make()
    return store[name]


def kept_in_task(name: str, make: Callable[[], object]) -> object:
    """As ``kept_by_worker``, until ``give_back``."""
    return kept_by_worker("in task", dict).setdefault(name, make())


def give_back() -> None:
    """Return memory that this process has freed to the system; idle workers live on between stages."""
    kept_by_worker("in task", dict).clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def frees(run: Callable) -> Callable:
    """``run``, a function of a task's batches or of a group's table, that then gives memory back."""
    if inspect.isgeneratorfunction(run):

        def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from run(batches)
            finally:
                give_back()

        return of_batches

    def of_group(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return of_group
