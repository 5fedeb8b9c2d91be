"""Exact dedup by distributed MSD radix partitioning.

Texts are compared by their own bytes: each round splits the groups that are still open by their
next run of bytes. A group leaves when it holds one row, or when its texts have ended; rows that
left are never touched again. The run of bytes grows from round to round, so the number of rounds
is logarithmic in the longest text. No digest decides equality.

A round is one aggregation, which Spark pre-aggregates inside each task, and one join of the open
rows with the groups that have company. The join is by sorting at every size, where Spark splits a
hot group by itself; the groups come from a written table, so no aggregation stands in its way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from topictally.llm.rows import apart_from, numbered, without
from topictally.session import scratch_folder

WHITE_SPACE = r"[\x20\x09-\x0D]"
FIRST_RUN = 64
GROWTH = 16


def exact_dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", first_run: int = FIRST_RUN
) -> DataFrame:
    """One row per row of ``docs``, with the row that stays of its group of equal texts.

    Texts are equal when they are the same after all white space of ASCII is deleted. The row with
    the most code points in its original text stays, then the one with the smallest key, null keys
    last. Rows with the same key and text are separate rows of one group, of which one stays.
    A null text counts as empty, and all empty texts are one group. Other columns are not read.
    An empty table gives no rows.

    Returns key, ``keep_id`` (key of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256`` (of the compared text, for reports only).
    """
    folder = scratch_folder(docs.sparkSession, "exact-dedup")
    rows = _rows(numbered(docs.select(key, text), f"{folder}/docs"), text, key)
    return _settled(rows, folder, first_run).select(
        F.col("id").alias(key), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


@apart_from("_row", "_file", "_place", "_start")
def drop_exact_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_dedup``."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "exact-copies")
    rows = numbered(docs, f"{folder}/docs")
    dropped = _settled(_rows(rows, text, key), folder, FIRST_RUN).filter("NOT kept")
    dropped.select(F.col("row").alias("_row")).write.parquet(f"{folder}/dropped")
    return without(rows, spark.read.parquet(f"{folder}/dropped"))


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Numbered documents as rows to be settled."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    body = F.regexp_replace(whole, WHITE_SPACE, "").cast("binary")
    return docs.select(
        F.col("_row").alias("row"),
        F.col(key).alias("id"),
        F.char_length(whole).alias("points"),
        F.sha2(body, 256).alias("sha"),
        F.lit(0).cast("bigint").alias("class"),
        body.alias("rest"),
    )


def _settled(rows: DataFrame, folder: str, first_run: int) -> DataFrame:
    """Every row with its group's size, the key of the row that stays, and whether it does."""
    spark = rows.sparkSession
    open_rows = rows
    settled = []
    run = first_run
    while True:
        place = f"{folder}/run-{run}"
        keyed = open_rows.select(
            "row", "id", "points", "sha", "class",
            F.substring("rest", 1, run).alias("digit"),
            F.expr(f"substring(rest, {run + 1})").alias("rest"),
        )
        rank = F.struct(-F.col("points"), F.col("id").isNull(), F.col("id"), F.col("row"))
        groups = (
            keyed.groupBy("class", "digit")
            .agg(F.count(F.lit(1)).alias("size"), F.min(rank).alias("best"))
            .filter("size > 1")
            .select(
                "class",
                "digit",
                "size",
                F.col("best.id").alias("best_id"),
                F.col("best.row").alias("best_row"),
                F.monotonically_increasing_id().alias("next"),
            )
        )
        groups.write.parquet(f"{place}/groups")
        shared = spark.read.parquet(f"{place}/groups")
        ended = F.col("size").isNull() | (F.length("digit") < run)
        split = keyed.join(shared.hint("merge"), ["class", "digit"], "left").select(
            "row", "id", "points", "sha", "size", "best_id", "best_row",
            F.col("next").alias("class"),
            F.when(~ended, F.col("rest")).alias("rest"),
        )
        split.write.parquet(f"{place}/rows")
        split = spark.read.parquet(f"{place}/rows")
        settled.append(split.filter("rest IS NULL").drop("rest", "class"))
        open_rows = split.filter("rest IS NOT NULL").drop("size", "best_id", "best_row")
        if open_rows.isEmpty():
            break
        run *= GROWTH
    alone = F.col("size").isNull()
    return reduce(DataFrame.unionByName, settled).select(
        "row",
        "id",
        "sha",
        F.when(alone, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
    )
