"""Prefix trie of conversations: burst tries.

1. A turn becomes a digest, a conversation the sequence of its turns' digests, equal sequences one row with
   their count, smallest conversation and the digest of all its conversations' ids.
2. A container holds the sequences below one node of the trie, its head. The root's container is burst at
   once, and so is each one with more than ``ROWS`` sequences or ``TURNS`` turns: along the turns that all its
   sequences share, then by the next turn id. What is burst becomes nodes above the containers.
3. The remaining containers are dealt to shards. Each is sorted, and a sweep over neighbouring sequences
   opens and closes its nodes; members, leaves and saved tokens are summed as nodes close.
4. The burst nodes sum what the containers' heads and the sequences that end there pass up to them.

No task holds more than a shard's containers, whose sizes are bounded, or one sequence of digests (24 bytes
a turn; texts are never gathered). Ids of equal sequences stream through their digest in sorted order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topictally.session import scratch_folder

#: Sequences and turns of a container, and turns of a shard.
ROWS, TURNS, SHARD = 2_000, 200_000, 400_000
#: Bytes of a turn's digest.
UNIT = 16
WORDS = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """Bytes that tell a turn's role and text from all others."""
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * UNIT))


def sequences(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Each conversation as ``key``, ``ids`` (its turns' digests end to end) and ``words`` (of each turn).

    Turns are in order, null first, equal ones by their digest; null texts and roles count as empty, and rows
    without a key belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    told = turns.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        turn_digest(role, text).alias("id"),
        F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("words"),
    )
    # Structs sort by their fields in order, nulls first.
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id", "words")))
    lists = told.groupBy("key").agg(ordered.alias("turns"))
    return lists.select(F.col("key").alias(key), *_parts(F.col("turns")))


def _parts(turns: Column) -> list[Column]:
    ids = F.transform(turns, lambda t: F.hex(t["id"]))
    return [F.unhex(F.array_join(ids, "")).alias("ids"), F.transform(turns, lambda t: t["words"]).alias("words")]


def rebuilt(whole: DataFrame, of: Column, shared: Column, most: int, key: str = "conv_id") -> DataFrame:
    """``whole`` with the first ``shared`` turns of conversation ``of`` in place of each one's own first ones.

    ``of`` and ``shared`` are expressions of the key, ``shared`` at most ``most``.
    """
    heads = whole.select(
        F.col(key).alias("_of"),
        F.substring("ids", 1, most * UNIT).alias("_ids"),
        F.slice("words", 1, most).alias("_words"),
    )
    own = whole.select(key, "ids", "words", of.alias("_of"), shared.cast("int").alias("_shared"))
    joined = own.join(heads, "_of", "left")
    none = F.array().cast("array<bigint>")
    ids = F.concat(
        F.coalesce(F.expr(f"substring(_ids, 1, {UNIT} * _shared)"), F.lit(b"")),
        F.expr(f"substring(ids, {UNIT} * _shared + 1)"),
    )
    words = F.concat(
        F.coalesce(F.expr("slice(_words, 1, _shared)"), none),
        F.expr("slice(words, _shared + 1, greatest(0, size(words) - _shared))"),
    )
    return joined.select(key, ids.alias("ids"), words.alias("words"))


def _distinct(rows: DataFrame, key: str, folder: str) -> DataFrame:
    """Rows key, ids, words to ``seq, ids, words, conv, n, ends``, one for each sequence."""
    spark = rows.sparkSession
    rows.select(F.sha2("ids", 256).alias("seq"), F.col(key).alias("conv"), "ids", "words").write.parquet(
        f"{folder}/sequences"
    )
    rows = spark.read.parquet(f"{folder}/sequences")
    # Sorted, so that however many conversations have a sequence, one id is held at a time.
    sorted_ids = rows.select("seq", "conv").repartition("seq").sortWithinPartitions("seq", "conv")
    ends = sorted_ids.mapInArrow(_digests_of_ids, "seq string, conv bigint, n bigint, ends string")
    bodies = rows.groupBy("seq").agg(F.any_value("ids").alias("ids"), F.any_value("words").alias("words"))
    bodies.join(ends, "seq").write.parquet(f"{folder}/distinct")
    return spark.read.parquet(f"{folder}/distinct")


def _digests_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (seq, id) to one row a sequence: its smallest id, their number, and their digest."""
    now, least, count, told = None, 0, 0, hashlib.sha256()

    def row() -> pa.RecordBatch:
        columns = [pa.array([now]), pa.array([least], pa.int64()), pa.array([count], pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([told.hexdigest()])], ["seq", "conv", "n", "ends"]
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for seq, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if seq != now:
                if now is not None:
                    held.append(row())
                now, least, count, told = seq, conv, 0, hashlib.sha256()
            told.update(f",{conv}".encode() if count else str(conv).encode())
            count += 1
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if now is not None:
        yield row()


def _prefix(depth: str) -> Column:
    """The name of the node that a sequence passes at a depth."""
    return F.sha2(F.expr(f"substring(ids, 1, {UNIT} * {depth})"), 256)


def _common(least: pd.Series, most: pd.Series) -> pd.Series:
    """Turns that the least and the most of some sequences share, and so all between them."""
    return pd.Series([shared_turns(a, b) for a, b in zip(least, most)])


def shared_turns(a: bytes, b: bytes) -> int:
    width = min(len(a), len(b)) // UNIT
    left = np.frombuffer(a, dtype=f"V{UNIT}", count=width)
    right = np.frombuffer(b, dtype=f"V{UNIT}", count=width)
    apart = np.flatnonzero(left != right)
    return int(apart[0]) if len(apart) else width


def _burst(distinct: DataFrame, rows: int, turns: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """The sequences in containers small enough, and those that end at a burst node.

    ``cuts`` are the depths of the burst nodes that a sequence passes, ``depth`` that of its container's head.
    """
    spark = distinct.sparkSession
    shared_by = F.pandas_udf(_common, "int")
    length = F.size("words")
    # The root is burst at once.
    now = distinct.withColumn("depth", F.lit(1)).withColumn("cuts", F.array(F.lit(0)))
    ended, small = [now.filter(length == 0)], []
    now = now.filter(length > 0)
    step = 0
    while True:
        place = f"{folder}/burst-{step}"
        now.withColumn("head", _prefix("depth")).write.parquet(f"{place}/rows")
        now = spark.read.parquet(f"{place}/rows")
        sizes = now.groupBy("head").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.size("words") - F.col("depth")).alias("turns")
        )
        large = sizes.filter((F.col("rows") > rows) | (F.col("turns") > turns)).filter("rows > 1")
        large.select("head").write.parquet(f"{place}/large")
        large = spark.read.parquet(f"{place}/large")
        small.append(now.join(large, "head", "left_anti"))
        over = now.join(large, "head", "left_semi")
        if large.isEmpty():
            break
        spans = over.groupBy("head").agg(F.min("ids").alias("least"), F.max("ids").alias("most"))
        spans.select("head", shared_by("least", "most").alias("shared")).write.parquet(f"{place}/spans")
        over = over.join(spark.read.parquet(f"{place}/spans"), "head").drop("head")
        # All nodes from the head down to the last one that all share are burst.
        cuts = F.concat("cuts", F.sequence("depth", "shared"))
        over = over.withColumn("cuts", cuts).withColumn("depth", F.col("shared") + 1)
        ended.append(over.filter(length == F.col("shared")).drop("shared"))
        now = over.filter(length > F.col("shared")).drop("shared")
        step += 1

    def union(parts: list[DataFrame]) -> DataFrame:
        whole = parts[0].select("seq", "ids", "words", "conv", "n", "ends", "depth", "cuts")
        for part in parts[1:]:
            whole = whole.unionByName(part.select(*whole.columns))
        return whole

    return union(small), union(ended)


NODES = (
    "depth bigint, conv bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, "
    "ends string, above array<struct<node: string, depth: bigint, words: bigint>>"
)


def _above(ids: bytes, words, cuts) -> list[dict]:
    """The burst nodes on a sequence's path: name, depth and words of the last turn."""
    return [
        {
            "node": hashlib.sha256(ids[: UNIT * k]).hexdigest(),
            "depth": int(k),
            "words": int(words[k - 1]) if k else 0,
        }
        for k in cuts
    ]


def sweep(container: list[tuple[bytes, list[int], int, int, str]], depth: int) -> list[list]:
    """The nodes of sequences (ids, words, conv, n, ends) that share their first ``depth`` turns.

    Each is a list: depth, conv, place of the parent in the result (-1 for the head), n, children, leaves,
    saved, ends. Sequences that begin with another one follow it in sorted order.
    """
    container.sort(key=lambda row: row[0])
    nodes: list[list] = []
    words_of: list[int] = []
    path: list[int] = []  # places of the open nodes, from the head down
    before = None

    def close_to(kept: int) -> None:
        while len(path) > kept:
            place = path.pop()
            node = nodes[place]
            node[5] = node[5] or 1  # nothing below it: a leaf
            node[6] += (node[3] - 1) * words_of[place]
            if path:
                above = nodes[path[-1]]
                above[1] = min(above[1], node[1])
                above[3] += node[3]
                above[4] += 1
                above[5] += node[5]
                above[6] += node[6]

    for ids, words, conv, n, ends in container:
        shared = shared_turns(before, ids) if before is not None else depth - 1
        close_to(shared - depth + 1)
        for k in range(shared, len(ids) // UNIT):
            nodes.append([k + 1, conv, path[-1] if path else -1, 0, 0, 0, 0, NOTHING])
            words_of.append(int(words[k]))
            path.append(len(nodes) - 1)
        last = nodes[path[-1]]
        last[3], last[7] = n, ends
        before = ids
    close_to(0)
    return nodes


def _swept(containers: DataFrame, turns: int) -> DataFrame:
    """The nodes of all containers; ``above`` is filled for heads only."""
    total = containers.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(1, math.ceil(total / turns))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, container in rows.groupby("head", sort=False):
            first = container.iloc[0]
            depth = int(first["depth"])
            above = _above(first["ids"], first["words"], first["cuts"])
            fields = (container[c] for c in ("ids", "words", "conv", "n", "ends"))
            nodes = sweep(list(zip(*fields)), depth)
            for at, conv, parent, *sums in nodes:
                head = parent < 0
                out.append([at, conv, None if head else nodes[parent][1], *sums, above if head else None])
        columns = [c.split()[0] for c in NODES.split(", ")[:9]]
        return pd.DataFrame(out, columns=columns).astype({"parent": "Int64"})

    keyed = containers.withColumn("head", _prefix("depth"))
    shard = F.pmod(F.xxhash64("head"), F.lit(shards)).alias("shard")
    return keyed.drop("seq").withColumn("shard", shard).groupBy("shard").applyInPandas(run, NODES)


def prefix_trie(
    rows: DataFrame,
    key: str = "conv_id",
    limits: tuple[int, int, int] = (ROWS, TURNS, SHARD),
) -> DataFrame:
    """The nodes of the trie of sequences (key, ids, words), as ``sequences`` or ``rebuilt`` gives them.

    One row for each distinct beginning, the empty one (the root) included: key (smallest member),
    ``depth``, ``parent_<key>`` (the parent's smallest member, null for the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (nodes without children in its subtree, itself included), ``saved_tokens`` (over its
    subtree, a node's members less one times the words of its last turn) and ``ends_sha256`` (of the ids of the
    members that end there, ascending, joined by commas). Keys are whole numbers and distinct. No
    rows give no nodes. ``limits`` bounds the sequences and turns of a container and the turns of a shard.
    """
    spark = rows.sparkSession
    folder = scratch_folder(spark, "prefix-trie")
    distinct = _distinct(rows.select(key, "ids", "words"), key, folder)
    containers, ended = _burst(distinct, limits[0], limits[1], folder)
    _swept(containers, limits[2]).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")

    path_type = "array<struct<node: string, depth: bigint, words: bigint>>"
    on_path = F.udf(lambda ids, words, cuts: _above(ids, words, cuts), path_type)
    none = F.lit(0).cast("bigint")
    ends = ended.select(
        "conv", "n", none.alias("leaves"), none.alias("saved"), "ends",
        on_path("ids", "words", "cuts").alias("above"),
    )
    heads = nodes.filter("above IS NOT NULL").select("conv", "n", "leaves", "saved", "above")
    heads = heads.withColumn("ends", F.lit(None).cast("string"))
    # What each head and ended sequence passes up to the burst nodes above it; tasks add it up first.
    passed = heads.unionByName(ends).select("*", F.posexplode("above").alias("at", "burst"))
    last = F.col("at") == F.size("above") - 1
    burst = passed.groupBy(F.col("burst.node").alias("node")).agg(
        F.any_value("burst.depth").alias("depth"),
        F.any_value("burst.words").alias("words"),
        F.any_value(F.slice("above", F.lit(1), F.col("at"))).alias("above"),
        F.min("conv").alias("conv"),
        F.sum("n").alias("n"),
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.count_if(last & F.col("ends").isNull()).alias("heads"),
        F.max(F.when(last, F.col("ends"))).alias("ends"),
    )
    burst.write.parquet(f"{folder}/upper")
    burst = spark.read.parquet(f"{folder}/upper")
    parent = F.when(F.size("above") > 0, F.element_at("above", -1)["node"]).alias("parent")
    own = ((F.col("n") - 1) * F.col("words")).alias("own")
    # Burst nodes count for themselves and for those above them too.
    path = F.concat(F.transform("above", lambda a: a["node"]), F.array("node"))
    below = burst.select(F.explode(path).alias("node"), own)
    below = below.groupBy("node").agg(F.sum("own").alias("own"))
    children = burst.select(parent.alias("node")).filter("node IS NOT NULL")
    children = children.groupBy("node").agg(F.count(F.lit(1)).alias("more"))
    named = burst.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    upper = burst.withColumn("parent", parent).join(below, "node").join(children, "node", "left")
    upper = upper.join(named, "parent", "left").withColumn(
        "children", F.col("heads") + F.coalesce("more", none)
    )

    def told(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
        return df.select(*(F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()))

    result = {
        key: "conv", "depth": F.col("depth").cast("bigint"), f"parent_{key}": "parent_conv", "n_convs": "n",
        "n_children": "children", "n_leaves": "leaves", "saved_tokens": "saved", "ends_sha256": "ends",
    }
    of_upper = result | {
        "n_leaves": F.greatest("leaves", F.when(F.col("children") == 0, 1).otherwise(0).cast("bigint")),
        "saved_tokens": F.col("saved") + F.col("own"),
        "ends_sha256": F.coalesce("ends", F.lit(NOTHING)),
    }
    inner = nodes.filter("above IS NULL").withColumn("parent_conv", F.col("parent"))
    tops = nodes.filter("above IS NOT NULL").drop("parent")
    tops = tops.withColumn("parent", F.element_at("above", -1)["node"]).join(named, "parent")
    return told(upper, of_upper).unionByName(told(inner, result)).unionByName(told(tops, result))
