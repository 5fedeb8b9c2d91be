"""Merkle manifest of a table: cogrouped subtree exchange.

Each row is a leaf; the leaves of a group (a language) form a binary tree by key, the groups' roots one
more tree above them. Texts are read once and never shuffled, only digests are.

1. Leaves are numbered in order without a window over a group: the table is sorted by ranges, and the
   counts of earlier ranges are added up. So a group with a third of all rows is in many ranges.
2. ``LEVELS`` levels are reduced at once: a superblock is the aligned run of ``2 ** LEVELS`` nodes below one
   node. Its root goes to the next round, until each group and then the whole table has one node.
3. Downwards, a superblock's nodes are cogrouped with the nodes outside it that its proofs need, which
   finishes the reduction, joins the proofs and folds them in one call of ``applyInPandas``.

A call holds ``2 ** LEVELS`` nodes and one outer path, whatever the table holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from topictally.session import scratch_folder

#: Levels of a tree that one call reduces.
LEVELS = 9
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A step of a path: the side its sibling is on (or that there is none), then the sibling.
LEFT, RIGHT, ALONE = b"L", b"R", b"-"
STEP = 33


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests, which are taken as hex text."""
    return hashlib.sha256("".join(part.hex() for part in parts).encode()).digest()


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256))


def climb(nodes: list[bytes], levels: int | None) -> list[list[bytes]]:
    """The levels above ``nodes``, themselves first: so many, or until one node is left."""
    found = [nodes]
    while len(found[-1]) > 1 if levels is None else len(found) <= levels:
        below = found[-1]
        found.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def path_of(levels: list[list[bytes]], place: int) -> bytes:
    """The steps from a node of the lowest level to the highest."""
    steps = []
    for nodes in levels[:-1]:
        beside = place ^ 1
        if beside >= len(nodes):
            steps.append(ALONE + bytes(STEP - 1))
        else:
            steps.append((LEFT if beside < place else RIGHT) + nodes[beside])
        place >>= 1
    return b"".join(steps)


def siblings(path: bytes) -> list[bytes]:
    steps = (path[i : i + STEP] for i in range(0, len(path), STEP))
    return [step[1:] for step in steps if step[:1] != ALONE]


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the steps above it lead to."""
    node = leaf
    for i in range(0, len(path), STEP):
        side, beside = path[i : i + 1], path[i + 1 : i + STEP]
        if side == ALONE:
            node = digest(node)
        else:
            node = digest(beside, node) if side == LEFT else digest(node, beside)
    return node


def _ranked(rows: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 in each ``tree`` and ``size``, the tree's number of rows."""
    spark = rows.sparkSession
    sorted_rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # Range and place in it; written, so that the numbers stay when a task runs again.
    sorted_rows.withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{folder}/sorted")
    placed = spark.read.parquet(f"{folder}/sorted").withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("tree", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first")
    )
    counts.write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    # A row for each range and tree in it, so no more than ranges and trees together.
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("offset"),
        F.sum("n").over(whole).alias("size"),
    )
    ranked = placed.join(offsets, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("offset"))
    return ranked.drop("at", "part", "offset")


def _reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """The superblocks' roots of ``tree, rank, size, node`` as such rows."""
    block = F.shiftright("rank", levels).alias("block")
    schema = "tree string, rank bigint, size bigint, node binary"

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        tree, size = rows["tree"].iloc[0], int(rows["size"].iloc[0])
        up = climb(list(rows["node"]), None if size <= 1 << levels else levels)
        rank = int(rows["rank"].iloc[0]) >> levels
        above = -(-size >> levels)
        return pd.DataFrame({"tree": [tree], "rank": [rank], "size": [above], "node": [up[-1][0]]})

    keyed = nodes.select("tree", "rank", "size", "node", block)
    return keyed.groupBy("tree", "block").applyInPandas(reduce, schema)


def _rounds(nodes: DataFrame, levels: int, folder: str) -> list[DataFrame]:
    """``nodes`` and the superblocks' roots above them, until each tree has one."""
    spark, found = nodes.sparkSession, [nodes]
    while (found[-1].agg(F.max("size")).first()[0] or 0) > 1:
        place = f"{folder}/{len(found)}"
        _reduced(found[-1], levels).write.parquet(place)
        found.append(spark.read.parquet(place))
    return found


def _inner_paths(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The paths of ``nodes``, from those of their superblocks' roots (tree, rank, path)."""
    schema = "tree string, rank bigint, path binary"

    def join(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        up = climb(list(rows["node"]), None if rows["size"].iloc[0] <= 1 << levels else levels)
        paths = [path_of(up, i) + above["path"].iloc[0] for i in range(len(rows))]
        return pd.DataFrame({"tree": rows["tree"], "rank": rows["rank"], "path": paths})

    return _cogrouped(nodes, outer, levels).applyInPandas(join, schema)


def _cogrouped(nodes: DataFrame, outer: DataFrame, levels: int):
    inner = nodes.withColumn("block", F.shiftright("rank", levels)).groupBy("tree", "block")
    return inner.cogroup(outer.withColumn("block", F.col("rank")).groupBy("tree", "block"))


def _downwards(rounds: list[DataFrame], paths: DataFrame, levels: int, folder: str) -> DataFrame:
    """The paths of the superblocks' roots of the lowest round, from those of the highest nodes."""
    for number in range(len(rounds) - 2, 0, -1):
        _inner_paths(rounds[number], paths, levels).write.parquet(f"{folder}/paths-{number}")
        paths = paths.sparkSession.read.parquet(f"{folder}/paths-{number}")
    return paths


RESULT = "leaf binary, subroot binary, root binary, path binary, proof binary, folded binary"


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    presented: Mapping[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """The manifest of each row of ``docs`` with its proof, and the root that a presented row leads to.

    A leaf is the SHA-256 of its fields, each ``-`` if null, else byte count, colon and value. In each group leaves
    ascend by key (null first, equal keys by leaf, so repeated rows are neighbours); every two
    consecutive nodes become the SHA-256 of their hex digests, a last one alone that of its own, until one is
    left: the subroot. Null is a group like any other. The subroots, ordered by group (null first,
    bytewise), give the root likewise.

    ``presented`` replaces fields by other values, as someone might show them; their leaf is folded with the
    original siblings. Returns key and, as binary, ``leaf``, ``subroot``, ``root``, ``path`` (33 bytes a step: L, R or
    ``-`` for the sibling's side, then the sibling), ``proof`` (SHA-256 of the siblings, lowest first) and ``folded``.
    An empty table gives no rows. Other columns are not read.
    """
    if not 1 <= levels <= 20:
        raise ValueError("levels must be from 1 to 20")
    spark = docs.sparkSession
    folder = scratch_folder(spark, "merkle")
    shown = [(presented or {}).get(f, F.col(f)) for f in fields]
    leaf, other = leaf_digest([F.col(f) for f in fields]), leaf_digest(shown)
    # Text that cannot be mistaken for another group's; null comes first.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"),
        F.col(key).alias("key"),
        leaf.alias("node"),
        other.alias("shown"),
        # Parts repeated rows, so that ranges can cut a third of a table of them.
        F.monotonically_increasing_id().alias("row"),
    )
    leaves.write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves")
    ranked = _ranked(leaves, ["key", "node", "row"], f"{folder}/ranks").drop("row")
    ranked.write.parquet(f"{folder}/ranked")
    ranked = spark.read.parquet(f"{folder}/ranked")
    rounds = _rounds(ranked, levels, f"{folder}/inner")
    subroots = rounds[-1].select("tree", "node")

    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    _ranked(tops, ["name"], f"{folder}/top").write.parquet(f"{folder}/tops")
    tops = spark.read.parquet(f"{folder}/tops")
    above = _rounds(tops, levels, f"{folder}/above")
    root = above[-1].select(F.col("node").alias("root"))
    paths = above[-1].select("tree", "rank", F.lit(b"").alias("path"))
    if len(above) > 1:
        paths = _inner_paths(above[0], _downwards(above, paths, levels, f"{folder}/above"), levels)
    named = tops.select("rank", F.col("name").alias("tree"), F.col("node").alias("subroot"))
    # One row for each group, and one for the table.
    named = named.join(paths.select("rank", "path"), "rank").withColumn("root", root.scalar())
    named.write.parquet(f"{folder}/named")
    named = spark.read.parquet(f"{folder}/named")

    paths = named.select("tree", F.lit(0).cast("bigint").alias("rank"), "path")
    outer = _downwards(rounds, paths, levels, f"{folder}/inner")
    # What each superblock of leaves needs from outside: its path, its group's root, the root.
    outer = outer.join(named.select("tree", "subroot", "root"), "tree")
    key_type = docs.schema[key].dataType.simpleString()

    def finish(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        size, (top,) = rows["size"].iloc[0], above.to_dict("records")
        up = climb(list(rows["node"]), None if size <= 1 << levels else levels)
        found = [path_of(up, i) + top["path"] for i in range(len(rows))]
        return pd.DataFrame(
            {
                "key": rows["key"],
                "leaf": rows["node"],
                "subroot": [top["subroot"]] * len(rows),
                "root": [top["root"]] * len(rows),
                "path": found,
                "proof": [digest(*siblings(path)) for path in found],
                "folded": [folded(leaf, path) for leaf, path in zip(rows["shown"], found)],
            }
        )

    # As text, for pandas turns whole numbers with nulls into floats.
    told = ranked.withColumn("key", F.col("key").cast("string"))
    done = _cogrouped(told, outer, levels).applyInPandas(finish, f"key string, {RESULT}")
    others = [c for c in done.columns if c != "key"]
    return done.select(F.col("key").cast(key_type).alias(key), *others)
