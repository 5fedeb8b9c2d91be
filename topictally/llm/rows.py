"""Numbers for rows that stay the same whenever a table is read again."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, functions as F

#: Steps of a plan that read a table and give the rows of its files.
SCAN = re.compile(r"Project|Filter|Relation|LogicalRelation")
#: An address without a host; ``_metadata.file_path`` has one slash there, lists of files have three.
NO_HOST = re.compile(r"^([A-Za-z][\w+.-]*):///")
#: Rows that a file may hold; the numbers of its rows begin at a multiple of this.
FILE_ROWS = 1 << 40


def apart_from(*names: str) -> Callable:
    """For operators that give a table's columns back: their helper columns may be named as in the table.

    A column named like a helper, in any case, has another name while the operator works.
    """

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(docs: DataFrame, *args, **settings) -> DataFrame:
            taken = [c for c in docs.columns if c.lower() in names]
            if not taken:
                return operator(docs, *args, **settings)
            used = {*names, *(c.lower() for c in docs.columns)}
            aside: dict[str, str] = {}
            for name in taken:
                other = f"{name}_of_table"
                while other.lower() in used:
                    other += "_"
                used.add(other.lower())
                aside[name] = other
            out = operator(_renamed(docs, aside), *args, **settings)
            return _renamed(out, {other: name for name, other in aside.items()})

        return run

    return decorate


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns))


def numbered(docs: DataFrame, folder: str, name: str = "_row") -> DataFrame:
    """``docs`` with a unique number in each row.

    How a scan is split depends on the cores that are there when a job is planned, so places in a
    split are no numbers to keep. Rows of Parquet files are numbered by their file and their place in
    it, which no split changes; texts are then not written once more. Anything else is written below
    ``folder`` first, with its numbers.
    """
    files = _files(docs)
    if files is None:
        docs.withColumn(name, F.monotonically_increasing_id()).write.parquet(folder)
        return docs.sparkSession.read.parquet(folder)
    row = docs.metadataColumn("_metadata")
    addressed = docs.select("*", row["file_path"].alias("_file"), row["row_index"].alias("_place"))
    table = [(path, number * FILE_ROWS) for number, path in enumerate(files)]
    starts = docs.sparkSession.createDataFrame(table, "_file string, _start bigint")
    # A row of a file that is not in the list must not get lost.
    unknown = F.raise_error(F.concat(F.lit("no number for the file "), "_file")).cast("bigint")
    number = F.coalesce("_start", unknown) + F.col("_place")
    counted = addressed.join(F.broadcast(starts), "_file", "left").withColumn(name, number)
    return counted.select(*(f"`{c}`" for c in docs.columns), name)


def _files(docs: DataFrame) -> list[str] | None:
    """The files of a plain scan of Parquet; None if rows cannot be numbered by them.

    That is so for other plans and formats, for files that are read twice, and for columns or filters
    that differ from one run to the next.
    """
    plan = docs._jdf.queryExecution().optimizedPlan()
    steps = [line.lstrip(" +-:") for line in plan.toString().splitlines() if line.strip()]
    if not (docs.inputFiles() and all(SCAN.match(step) for step in steps) and plan.deterministic()):
        return None
    leaf = plan.collectLeaves().head()
    if leaf.getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = leaf.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return None
    if relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat":
        return None
    files = sorted(NO_HOST.sub(r"\1:/", path) for path in relation.location().inputFiles())
    return files if len(set(files)) == len(files) else None


def without(docs: DataFrame, dropped: DataFrame, name: str = "_row") -> DataFrame:
    """The rows of numbered ``docs`` that are not in the written table ``dropped``.

    Spark broadcasts the numbers where the table is small, and else joins by sorting.
    """
    return docs.join(dropped, name, "left_anti").drop(name)
