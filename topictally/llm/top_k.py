"""Exact search for the vectors with the highest inner products, by tiles.

1. Components become whole numbers, so scores are exact. Rows are dealt by a hash of their number into
   shards of about ``SHARD`` candidates and blocks of about ``BLOCK`` queries, packed as one matrix each, in the
   smallest type of whole numbers that holds them.
2. A tile is a block and a shard. It multiplies a strip of queries after the other with the shard and
   keeps each query's best by partial selection; only its lists leave the task.
3. Lists of ``FAN`` tiles are merged, then of ``FAN`` such merges, until each block has one.

A task holds a block, a shard and the scores of a strip, or the lists of ``FAN`` tiles. The stated queries meet
all rows, so work grows with their product; what is sent is that divided by the sizes of a tile.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from topictally.session import scratch_folder

#: Candidates of a shard, queries of a block, queries multiplied at once, lists merged at once.
SHARD, BLOCK, STRIP, FAN = 8192, 2048, 256, 16
#: Whole numbers up to these are exact in floats of 32 and 64 bits.
EXACT_32, EXACT_64 = 1 << 24, 1 << 53

PACKED = "rows binary, ids binary, known binary, kind string, width int, most double, cells binary"
LISTS = "query binary, row binary, id binary, known binary, score binary"


def whole_components(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, null for a vector that takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * scale)))


def smallest_kind(most: int) -> str:
    return next(k for k, top in (("i1", 127), ("i2", 32767), ("i4", 2**31 - 1), ("i8", 2**63)) if most <= top)


def _pack(rows: pd.DataFrame, place: str) -> pd.DataFrame:
    """The rows of a block as one; shorter vectors are filled up with zeros."""
    known = rows["id"].notna().to_numpy()
    ids = np.array([int(i) if k else 0 for i, k in zip(rows["id"], known)], dtype=np.int64)
    numbers = rows["row"].to_numpy(np.int64)
    # Candidates lie in the order in which ties are decided.
    order = np.lexsort((numbers, ids, ~known))
    vectors = [rows["vector"].iloc[i] for i in order]
    width = max(map(len, vectors))
    cells = np.zeros((len(vectors), width), dtype=np.int64)
    for at, vector in enumerate(vectors):
        cells[at, : len(vector)] = vector
    most = max(int(cells.max(initial=0)), -int(cells.min(initial=0)))
    kind = smallest_kind(most)
    packed = [numbers[order], ids[order], known[order], cells.astype(kind)]
    rows_, ids_, known_, cells_ = (x.tobytes() for x in packed)
    columns = [rows[place].iloc[0], rows_, ids_, known_, kind, width, float(most), cells_]
    return pd.DataFrame([columns], columns=[place, "rows", "ids", "known", "kind", "width", "most", "cells"])


class Matrix:
    """A packed block."""

    def __init__(self, packed: dict):
        self.rows = np.frombuffer(packed["rows"], dtype=np.int64)
        self.ids = np.frombuffer(packed["ids"], dtype=np.int64)
        self.known = np.frombuffer(packed["known"], dtype=bool)
        self.most = int(packed["most"])
        cells = np.frombuffer(packed["cells"], dtype=packed["kind"])
        self.cells = cells.reshape(len(self.rows), packed["width"])


def best_of_tile(queries: Matrix, shard: Matrix, k: int) -> dict[str, np.ndarray]:
    """The ``k`` best candidates of each query: columns query, row, id, known and score."""
    width = min(queries.cells.shape[1], shard.cells.shape[1])
    count = len(shard.rows)
    bound = max(1, width) * max(1, queries.most) * max(1, shard.most)
    # A score and a place in one number: higher scores first, then earlier places.
    fits = (bound + 1) * count < EXACT_64
    kind = np.float32 if bound < EXACT_32 else np.float64 if bound < EXACT_64 else object
    if kind is object:
        left, right = queries.cells[:, :width].tolist(), shard.cells[:, :width].tolist()
        left, right = (np.array(x, dtype=object).reshape(len(x), width) for x in (left, right))
    else:
        left, right = queries.cells[:, :width].astype(kind), shard.cells[:, :width].astype(kind)
    kept = min(k + 1, count)  # one more, as a query's own row may be among them
    found = []
    for begin in range(0, len(queries.rows), STRIP):
        scores = left[begin : begin + STRIP] @ right.T
        if kind is object:
            scores = np.array([[max(-(1 << 63), min(s, (1 << 63) - 1)) for s in r] for r in scores.tolist()])
        scores = scores.astype(np.int64).reshape(-1, count)
        if fits:
            order = scores * count + np.arange(count - 1, -1, -1)
            best = np.argpartition(order, count - kept, axis=1)[:, count - kept :]
        else:
            best = np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :kept]
        at = np.repeat(np.arange(begin, begin + len(scores)), best.shape[1])
        column = best.ravel()
        score = np.take_along_axis(scores, best, axis=1).ravel()
        other = shard.rows[column] != queries.rows[at]
        at, column, score = at[other], column[other], score[other]
        found.append((queries.rows[at], shard.rows[column], shard.ids[column], shard.known[column], score))
    columns = [np.concatenate(c) for c in zip(*found)]
    return first_of_each(dict(zip(["query", "row", "id", "known", "score"], columns)), k)


def first_of_each(lists: dict[str, np.ndarray], k: int) -> dict[str, np.ndarray]:
    """The ``k`` best rows of each query, ranked."""
    # ~score, as the negative of the least whole number does not exist.
    ties = (lists["row"], lists["id"], ~lists["known"], ~lists["score"], lists["query"])
    order = np.lexsort(ties)
    lists = {name: values[order] for name, values in lists.items()}
    query = lists["query"]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.array([], int)
    sizes = np.diff(np.r_[starts, len(query)])
    rank = np.arange(len(query)) - np.repeat(starts, sizes)
    return {name: values[rank < k] for name, values in lists.items()} | {"rank": rank[rank < k] + 1}


_KINDS = {"query": "i8", "row": "i8", "id": "i8", "known": "?", "score": "i8"}


def _told(block: int, node: int, lists: dict[str, np.ndarray]) -> pd.DataFrame:
    values = [lists[name].astype(kind).tobytes() for name, kind in _KINDS.items()]
    return pd.DataFrame([[block, node, *values]], columns=["block", "node", *_KINDS])


def _heard(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    joined = {name: b"".join(rows[name]) for name in _KINDS}
    return {name: np.frombuffer(joined[name], dtype=kind) for name, kind in _KINDS.items()}


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` rows with the highest inner product for each row where ``is_query`` holds.

    Components are ``floor(scale * x)``. Candidates are all rows but the query's own; repeated rows are
    rows of their own, also next to a query of the same key. Ties go to the smaller key, null keys last,
    then to any one of repeated rows. Vectors that are null or hold null or non-finite components take no
    part, neither as query nor as candidate; an empty vector scores 0 with all. Of vectors of different
    lengths the shorter counts as filled up with zeros. Scores beyond 64 bits stay at their bounds. A null
    ``is_query`` is false. An empty table gives no rows.

    Returns ``query_id``, ``rank`` (from 1), the key and ``score``.
    """
    if k < 1 or shard < 1 or block < 1:
        raise ValueError("k, shard and block must be at least 1")
    spark = vectors.sparkSession
    folder = scratch_folder(spark, "top-k")
    whole = vectors.select(
        F.col(key).cast("bigint").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        whole_components(F.col(vector), scale).alias("vector"),
    ).filter("vector IS NOT NULL")
    # Written, so that a row has one number whenever it is read.
    whole.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/whole")
    whole = spark.read.parquet(f"{folder}/whole")
    count, asked = whole.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = max(1, math.ceil(count / shard)), max(1, math.ceil(asked / block))

    def packed(rows: DataFrame, place: str, parts: int) -> DataFrame:
        dealt = rows.select("row", F.col("id").cast("string").alias("id"), "vector")
        dealt = dealt.withColumn(place, F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
        return dealt.groupBy(place).applyInPandas(lambda g: _pack(g, place), f"{place} int, {PACKED}")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:  # no row's hash fell there
            return pd.DataFrame(columns=["block", "node", *_KINDS])
        (queries,), (own,) = left.to_dict("records"), right.to_dict("records")
        best = best_of_tile(Matrix(queries), Matrix(own), k)
        return _told(queries["block"], own["node"], best)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        best = first_of_each(_heard(rows), k)
        return _told(rows["block"].iloc[0], rows["node"].iloc[0] // FAN, best)

    # One row for each block and shard, so what is sent is bounded by the number of tiles.
    packed(whole.filter("asks"), "block", blocks).write.parquet(f"{folder}/blocks")
    packed(whole, "node", shards).write.parquet(f"{folder}/shards")
    left = spark.read.parquet(f"{folder}/blocks").withColumn("node", each(shards))
    right = spark.read.parquet(f"{folder}/shards").withColumn("block", each(blocks))
    schema = f"block int, node int, {LISTS}"
    tiles = left.groupBy("block", "node").cogroup(right.groupBy("block", "node"))
    lists = tiles.applyInPandas(tile, schema)
    while shards > 1:
        above = F.call_function("div", F.col("node"), F.lit(FAN))
        lists = lists.groupBy("block", above.alias("above")).applyInPandas(merge, schema)
        shards = -(-shards // FAN)

    def rows_of(batches):
        for batch in batches:
            for i in range(len(batch)):
                best = first_of_each(_heard(batch.iloc[i : i + 1]), k)
                ids = pd.array(best["id"], dtype="Int64")
                ids[~best["known"]] = pd.NA
                yield pd.DataFrame(
                    {"query": best["query"], "rank": best["rank"], "id": ids, "score": best["score"]}
                )

    ranked = lists.mapInPandas(rows_of, "query bigint, rank int, id bigint, score bigint")
    names = whole.filter("asks").select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", "rank", F.col("id").alias(key), "score")
