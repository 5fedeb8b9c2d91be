"""Top-k search, the prefix trie and the Merkle manifest against plain versions."""

import hashlib
import math
import random
import re
import struct
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from topictally.llm import merkle, prefix_trie, top_k

# Exact top-k search

VECTORS = "vec_id bigint, embedding array<float>, query_id int, rank string, id string, row int"


def plain_top_k(rows, asks, k, scale=64):
    """Best rows of each query by all pairs; of equal ones any."""
    known = []
    for place, (key, vector) in enumerate(rows):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((place, key, [math.floor(scale * x) for x in vector]))
    found = []
    for place, key, vector in known:
        if key is None or not asks(key):
            continue
        scores = [
            (-bounded(sum(a * b for a, b in zip(vector, v))), other is None, other or 0, p, other)
            for p, other, v in known
            if p != place
        ]
        best = sorted(scores)[:k]
        found += [(key, i, s[4], -s[0]) for i, s in enumerate(best, 1)]
    return sorted(found, key=repr)


def bounded(score):
    return max(-(2**63), min(2**63 - 1, score))


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def found_top_k(spark, rows, k, **settings):
    told = [(key, v, 1, "r", "i", 2) for key, v in rows]
    vectors = spark.createDataFrame(told, VECTORS).repartition(3)
    best = top_k.exact_top_k(vectors, F.col("vec_id") % 3 == 0, k, **settings)
    assert best.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in best.collect()), key=repr)


@pytest.mark.parametrize("shard, block", [(8192, 2048), (7, 5), (1, 1)])
def test_top_k(spark, shard, block):
    pick = random.Random(3)
    rows = [(i, [pick.uniform(-1, 1) for _ in range(5)]) for i in range(40)]
    rows += [(i, [0.5, 0.5, 0, 0, 0]) for i in range(40, 70)]  # ties
    rows += [(71, None), (72, [0.1, None]), (73, [float("nan")]), (75, [float("inf"), 1.0])]
    # Repeated keys and rows, no key, other lengths, nothing at all.
    rows += [(3, [1.0] * 5), (3, [1.0] * 5), (None, [1.0] * 5), (78, [1.0]), (81, []), (84, [2.0] * 7)]
    rows = [(k, v and [None if x is None else single(x) for x in v]) for k, v in rows]
    expected = plain_top_k(rows, lambda key: key % 3 == 0, 6)
    assert found_top_k(spark, rows, 6, shard=shard, block=block) == expected


def test_top_k_of_large_numbers(spark):
    """Scores beyond what floats hold exactly, and beyond 64 bits."""
    pick = random.Random(4)
    rows = [(i, [single(pick.uniform(-1, 1) * 10 ** (6 + i % 4)) for _ in range(3)]) for i in range(24)]
    assert found_top_k(spark, rows, 4, shard=5) == plain_top_k(rows, lambda key: key % 3 == 0, 4)


def test_top_k_of_few_or_no_rows(spark):
    assert found_top_k(spark, [], 3) == []
    assert found_top_k(spark, [(1, [1.0])], 3) == []
    assert found_top_k(spark, [(3, [1.0])], 3) == []
    assert found_top_k(spark, [(3, [1.0]), (4, [2.0])], 3) == [(3, 1, 4, 64 * 128)]


# Prefix trie

TURNS = "conv_id bigint, turn bigint, role string, text string, ids string, words string, head int"


def plain_trie(sequences):
    """Nodes of {conv: turns} by all beginnings."""
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [sums[c] for c in children[node]]
        leaves = sum(x[0] for x in below) or 1
        sums[node] = leaves, (len(members[node]) - 1) * words + sum(x[1] for x in below)
    found = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(sequences[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        found.append((min(convs), len(node), parent, len(convs), len(children[node]), *sums[node], digest))
    return sorted(found, key=repr)


def found_trie(spark, sequences, limits, shuffle=True):
    rows = [
        (conv, i, role, text, "x", "y", 1)
        for conv, turns in sequences.items()
        for i, (role, text) in enumerate(turns)
    ]
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    whole = prefix_trie.sequences(turns)
    empty = [c for c, t in sequences.items() if not t]
    if empty:
        none = F.array().cast("array<bigint>").alias("words")
        lone = spark.createDataFrame([(c,) for c in empty], "conv_id bigint")
        whole = whole.unionByName(lone.select("conv_id", F.lit(b"").alias("ids"), none))
    nodes = prefix_trie.prefix_trie(whole, limits=limits)
    assert nodes.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return sorted((tuple(r) for r in nodes.collect()), key=repr)


LIMITS = [(2000, 200_000, 400_000), (3, 1000, 20), (1, 1, 5)]


@pytest.mark.parametrize("limits", LIMITS)
def test_trie(spark, limits):
    pick = random.Random(5)
    roles = ["user", "assistant", ""]
    sequences = {
        conv: [(pick.choice(roles), pick.choice(["", "a", "b c", " d  e f "])) for _ in range(pick.randrange(0, 5))]
        for conv in range(60)
    }
    # Copies, a long shared beginning, one that ends inside it, keys of both signs.
    shared = [("user", f"turn {i}") for i in range(12)]
    sequences |= {100 + i: shared + [("user", str(i % 3))] for i in range(9)}
    sequences |= {-5: shared, -4: shared[:7], -3: shared[:7], 200: shared + [("user", "x")] * 30}
    assert found_trie(spark, sequences, limits) == plain_trie(sequences)


def test_trie_of_nothing(spark):
    assert found_trie(spark, {}, LIMITS[0]) == []
    assert found_trie(spark, {4: []}, LIMITS[0]) == plain_trie({4: []})


def test_sequences_have_an_order(spark):
    """Null turns first, equal ones in one order however they arrive; nulls count as empty."""
    rows = [
        (1, 2, "user", "c", "", "", 0),
        (1, None, "user", "a", "", "", 0),
        (1, 1, None, None, "", "", 0),
        (1, 1, "", "x", "", "", 0),
        (2, 1, "", "x", "", "", 0),
        (2, 2, "user", "c", "", "", 0),
        (2, None, "user", "a", "", "", 0),
        (2, 1, "", "", "", "", 0),
        (None, 1, "user", "lost", "", "", 0),
    ]
    found = prefix_trie.sequences(spark.createDataFrame(rows, TURNS).repartition(2)).orderBy("conv_id").collect()
    assert [r.conv_id for r in found] == [1, 2]
    assert found[0].ids == found[1].ids and len(found[0].ids) == 4 * prefix_trie.UNIT
    assert found[0].words == found[1].words and found[0].words[0] == 1


def test_rebuilt(spark):
    """The first turns come from another conversation, as many as there are."""
    sizes = {0: 2, 1: 5, 2: 1, 21: 3}
    rows = [(c, i, "user", f"{c} {i}", "", "", 0) for c, n in sizes.items() for i in range(n)]
    whole = prefix_trie.sequences(spark.createDataFrame(rows, TURNS))
    names = {r.conv_id: r.ids for r in whole.collect()}
    key = F.col("conv_id")
    for shared in (0, 1, 3):
        made = prefix_trie.rebuilt(whole, key - key % 20, F.lit(shared), 3).collect()
        unit = prefix_trie.UNIT
        for row in made:
            head = names.get(row.conv_id - row.conv_id % 20, b"")[: shared * unit]
            assert row.ids == head + names[row.conv_id][shared * unit :]
            assert len(row.words) == len(row.ids) // unit


def test_a_sweep_takes_more_batches_than_one(spark):
    """Equal sequences stream through their digest; batches have seven rows in the tests."""
    sequences = {conv: [("user", "same")] for conv in range(100)}
    assert found_trie(spark, sequences, LIMITS[0]) == plain_trie(sequences)


# Merkle manifest

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, key string, node int, tree int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """The root, and for each leaf its siblings and a way to fold another leaf."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])

    def siblings(at):
        return [
            n[(at >> i) ^ 1] if (at >> i) ^ 1 < len(n) else None for i, n in enumerate(levels[:-1])
        ]

    return levels[-1][0], siblings


def plain_fold(node, at, beside):
    for i, other in enumerate(beside):
        parts = [node] if other is None else [node, other] if not (at >> i) & 1 else [other, node]
        node = sha(*parts)
    return node


def plain_manifest(rows, shown):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = plain_tree([plain_leaf(r) for r in groups[name]])
    if not names:
        return []
    root, above = plain_tree([trees[n][0] for n in names])
    found = []
    for place, name in enumerate(names):
        subroot, siblings = trees[name]
        for at, row in enumerate(groups[name]):
            inner, outer = siblings(at), above(place)
            folded = plain_fold(plain_fold(plain_leaf(shown(row)), at, inner), place, outer)
            proof = sha(*(x for x in [*inner, *outer] if x is not None))
            found.append((row[0], plain_leaf(row), subroot, root, proof, folded))
    return sorted(found, key=repr)


def found_manifest(spark, rows, levels):
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], DOCS).repartition(3)
    changed = F.when(F.col("doc_id") % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    made = merkle.manifest(docs, presented={"n_chars": changed}, levels=levels)
    names = ("leaf", "subroot", "root", "proof", "folded")
    told = made.select("doc_id", *(F.lower(F.hex(n)) for n in names))
    return sorted((tuple(r) for r in told.collect()), key=repr)


def tampered(row):
    if row[0] is None or row[0] % 7 or row[3] is None:
        return row
    return (*row[:3], row[3] + 1, row[4])


@pytest.mark.parametrize("count, levels", [(0, 2), (1, 2), (2, 1), (5, 1), (33, 2), (33, 9)])
def test_manifest(spark, count, levels):
    rows = [(i, "s", "en", i, f"text é {i}") for i in range(count)]
    assert found_manifest(spark, rows, levels) == plain_manifest(rows, tampered)


@pytest.mark.parametrize("levels", [2, 9])
def test_manifest_of_awkward_rows(spark, levels):
    """Null fields and keys, equal keys, repeated rows, one group much larger than others."""
    rows = [(i, None, "de", None if i % 3 else i, "x" * i) for i in range(70)]
    rows += [(14, "s", lang, 3, None) for lang in (None, "", "en", "é", "de", "en")]
    rows += [(None, "s", None, 1, ""), (None, "s", None, 1, ""), (2**53 + 1, "s", "en", 2**60, "long")]
    assert found_manifest(spark, rows, levels) == plain_manifest(rows, tampered)


def test_only_untouched_rows_lead_to_the_root(spark):
    rows = [(i, "s", "en" if i % 3 else "de", i, "t") for i in range(40)]
    for doc_id, _, _, root, _, folded in found_manifest(spark, rows, 3):
        assert (folded == root) == (doc_id % 7 != 0)


def test_a_path_is_its_proof():
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(11)]
    levels = merkle.climb(nodes, None)
    for i, node in enumerate(nodes):
        path = merkle.path_of(levels, i)
        assert merkle.folded(node, path) == levels[-1][0]
        assert len(path) == merkle.STEP * (len(levels) - 1)
