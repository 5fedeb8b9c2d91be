import hashlib
import random
import re
from itertools import groupby

import numpy as np
import pytest

from topictally.llm import exact_dedup, jaccard_join
from topictally.llm.components import connected_components, star_forest

from .conftest import TEXTS


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute_groups(rows):
    found = []
    ranked = sorted(rows, key=lambda r: normal(r[1]))
    for body, group in groupby(ranked, key=lambda r: normal(r[1])):
        group = sorted(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        for i, (key, _) in enumerate(group):
            sha = hashlib.sha256(body.encode()).hexdigest()
            found.append((key, group[0][0], len(group), i == 0, sha))
    return sorted(found, key=repr)


@pytest.mark.parametrize("first_run", [1, 64])
def test_exact_dedup_of_awkward_rows(awkward, first_run):
    got = exact_dedup.exact_dedup(awkward, first_run=first_run)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_groups(TEXTS)


def test_exact_dedup_of_texts_that_share_beginnings(spark):
    pick = random.Random(3)
    rows = [(i, "ab" * pick.randint(0, 40) + pick.choice(["", "c", "cd"])) for i in range(300)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), first_run=2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_groups(rows)


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup.exact_dedup(nothing).collect() == []
    assert exact_dedup.drop_exact_copies(nothing).columns == nothing.columns


def test_drop_exact_copies_keeps_columns(awkward):
    kept = exact_dedup.drop_exact_copies(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len({normal(t) for _, t in TEXTS})


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


def brute_components(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    found = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        keys = [k for k in keys if k is not None]
        found.append((key, len(sets[i]), min(keys, default=None)))
    return sorted(found, key=repr)


def near_texts(seed):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(25):
        base = [pick.choice(words) for _ in range(pick.randint(1, 90))]
        for _ in range(pick.randint(1, 8)):
            copy = list(base)
            for _ in range(pick.randint(0, 4)):
                copy[pick.randrange(len(copy))] = pick.choice(words)
            rows.append((len(rows), " ".join(copy)))
    shared = " ".join(f"common{i}" for i in range(30))
    rows += [(len(rows) + i, f"{shared} {i} own {pick.random()}") for i in range(40)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
@pytest.mark.parametrize("block", [2048, 3])
def test_jaccard_components(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_texts(width + block)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    similarity = jaccard_join.Similarity(width, percent)
    got = jaccard_join.jaccard_components(docs, similarity)
    expected = brute_components(rows, width, percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
    assert len({c for _, _, c in expected}) < len(rows)


def test_jaccard_components_of_awkward_rows(awkward):
    got = jaccard_join.jaccard_components(awkward)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(TEXTS, 4, 85)


def test_jaccard_of_nothing(spark, nothing):
    assert jaccard_join.jaccard_components(nothing).collect() == []
    assert jaccard_join.drop_near_copies(nothing).columns == nothing.columns
    blank = spark.createDataFrame([(1, ""), (1, ""), (None, None)], "doc_id bigint, text string")
    got = jaccard_join.jaccard_components(blank).collect()
    assert sorted(map(tuple, got), key=repr) == [(1, 0, 1), (1, 0, 1), (None, 0, None)]


def test_drop_near_copies_keeps_one_of_each(awkward):
    kept = jaccard_join.drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, None, 4, 5, 6, 7, 8, 9, 11, 12, 13], key=repr)


@pytest.mark.parametrize("at_once", [0, 200_000])
def test_components(spark, tmp_path, at_once):
    pick = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)]
    edges += [(200 + pick.randrange(40), 200 + pick.randrange(40)) for _ in range(30)]
    edges += [(7, 7), (None, 3), (1, 2)]
    links = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    got = connected_components(links, str(tmp_path / "c"), at_once)
    found = {r["node"]: r["root"] for r in got.collect()}
    assert got.count() == len(found)
    root = {n: n for e in edges for n in e if n is not None}
    for _ in root:
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in edges if a is not None and a != b for n in (a, b)}
    assert found == {n: root[n] for n in linked}


def test_a_tasks_edges_become_stars():
    pick = random.Random(9)
    a = np.array([pick.randrange(300) for _ in range(250)])
    b = np.array([pick.randrange(300) for _ in range(250)])
    root = list(range(300))
    for _ in range(300):
        for x, y in zip(a, b):
            root[x] = root[y] = min(root[x], root[y])
    node, under = star_forest(a, b)
    assert dict(zip(node.tolist(), under.tolist())) == {n: r for n, r in enumerate(root) if n != r}
    assert len(star_forest(np.array([], int), np.array([], int))[0]) == 0
