"""BPE, quality rules, packing and the language model against plain versions."""

import bisect
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topictally.llm import bpe, elias_fano, ngram_lm, packing, quality

from .conftest import TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def random_texts(count, seed):
    pick = random.Random(seed)
    parts = list("abcdeTHEing '\n\t .,!?12é中ß\x1c\x85\xa0　😀’") + [
        "  ", "\n\n", "'s", "can't", "<|endoftext|>", "hello", " the", "\r\n", "​", "<|", "aaaa" * 12,
    ]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, 40))) for _ in range(count)]


def test_coder_equals_the_library(reference):
    coder = bpe.BytePairCoder(PATH)
    texts = random_texts(600, 4) + ["a" * 5000, "ab" * 700, " " * 3000]
    ids, counts = coder.encode_many(texts)
    at = 0
    for text, count in zip(texts, counts.tolist()):
        own = ids[at : at + count].tolist()
        at += count
        assert own == reference.encode(text, add_special_tokens=False).ids
        assert own == bpe.unpack(coder.encode(text))
        assert coder.decode(own) == text
    words = [w.encode() for t in texts for w in t.split()]
    assert coder.merge_many(words) == [bpe.pack(coder.merge(w)) for w in words]


def test_segment_tree_yields_the_least_and_leftmost():
    pick = random.Random(1)
    values = [pick.randrange(50) << 32 | i for i in range(37)]
    tree = bpe.SegmentTree(list(values))
    for _ in range(200):
        assert tree.nodes[1] == min(values)
        at = pick.randrange(37)
        values[at] = pick.choice([bpe.NONE, pick.randrange(50) << 32 | at])
        tree.update(at, values[at])


def test_code_documents(spark, awkward, nothing, reference):
    got = bpe.code_documents(awkward, PATH).collect()
    expected = [(i, reference.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in TEXTS]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert bpe.code_documents(nothing, PATH).collect() == []


def plain_judgement(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    repeats = len(covered)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        repeats,
        len(words) < 50 or 100 * repeats > 50 * len(words),
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_features(spark, awkward, nothing):
    texts = random_texts(60, 6)
    texts += [" ".join(random.Random(i).choices("abc|", k=80)) + "\nx y\nx y\n \n" for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id int, text string, lang string")
    got = {r["doc_id"]: tuple(r[c] for c in BASE) for r in quality.judge_documents(docs).collect()}
    assert got == {i: plain_judgement(t) for i, t in enumerate(texts)}
    judged = quality.judge_documents(awkward)
    found = sorted(((r["doc_id"], *(r[c] for c in BASE)) for r in judged.collect()), key=repr)
    assert found == sorted(((i, *plain_judgement(t)) for i, t in TEXTS), key=repr)
    assert quality.judge_documents(nothing).collect() == []
    assert quality.drop_low_quality(awkward).columns == awkward.columns


def plain_distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    both = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        both += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(both, 0) / 2)


def test_quality_verdicts_by_hand(spark):
    """The references counted by hand, the nearest one found by hand."""
    pick = random.Random(2)
    words = "the of and to in a is that for it was on are as with they at be this have".split()
    prose = [" ".join(pick.choices(words, k=pick.randint(60, 160))).capitalize() + "." for _ in range(60)]
    junk = [" ".join(w + "###" for w in pick.choices(words, k=120)), " | ".join(pick.choices(prose[0].split(), k=90))]
    rows = [(i, t, "en") for i, t in enumerate(prose)] + [(100 + i, t, None) for i, t in enumerate(junk)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    rules = quality.Rules(repeat_percent=100)
    judged = {r["doc_id"]: r for r in quality.judge_documents(docs, rules).collect()}
    counts, classes = Counter(), np.zeros(len(quality.CLASSES))
    for t in prose:
        counts.update(quality.stem(w) for w in t.encode().split())
        classes += quality.class_counts(t.encode())
    top = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: rules.common_words]]
    for key, text, _ in rows:
        stems = Counter(quality.stem(w) for w in text.encode().split())
        own = [stems[w] for w in top]
        of_words = plain_distance(
            [*own, sum(stems.values()) - sum(own)],
            [*(counts[w] for w in top), sum(counts.values()) - sum(counts[w] for w in top)],
        )
        of_classes = plain_distance(quality.class_counts(text.encode()).tolist(), classes.tolist())
        assert judged[key]["word_distance"] == pytest.approx(of_words)
        assert judged[key]["class_distance"] == pytest.approx(of_classes)
        assert judged[key]["kept"] == (key < 100)


@pytest.mark.parametrize("island", [8192, 40])
def test_pack(spark, island):
    pick = random.Random(island)
    lengths = [pick.choice([100, 1, 37, 99, 50, pick.randint(1, 100)]) for _ in range(500)]
    rows = [(i, n, "x") for i, n in enumerate(lengths)] + [(500, 0, "x"), (500, 0, "x")]
    pieces = spark.createDataFrame(rows, "number int, length int, offset string").repartition(3)
    packed = packing.pack(pieces, 100, packing.Evolution(island=island)).collect()
    assert Counter((r["number"], r["length"]) for r in packed) == Counter((i, n) for i, n, _ in rows)
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 100
    rooms = []  # best fit, longest first
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
        rooms.append((min(fitting) if fitting else 100) - length)
    assert len(bins) - 2 <= len(rooms) * (1 if island > 500 else 1.1)


def packed_alone(lengths, **sizes):
    """The bins of one island, after a look at what they hold."""
    bins = packing.Islander(lengths, 1024, packing.Evolution(**sizes), 7).evolve()
    assert sorted(d for _, held in bins for d in held) == list(range(len(lengths)))
    assert all(fill == sum(lengths[d] for d in held) <= 1024 for fill, held in bins)
    return len(bins)


def plain_best_fit(lengths, capacity=1024):
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    return len(rooms)


def test_search_finds_what_best_fit_does_not():
    pick = random.Random(5)
    lengths = [pick.randint(200, 500) for _ in range(4000)]
    best_fit = plain_best_fit(lengths)
    assert packed_alone(lengths, generations=0) > 0.98 * best_fit
    assert packed_alone(lengths) <= 0.97 * best_fit
    # Bins of three that are all full: the optimum is known.
    lengths = []
    for _ in range(500):
        one, other = pick.randint(250, 450), pick.randint(250, 450)
        lengths += [one, other, 1024 - one - other]
    assert plain_best_fit(lengths) > 530
    assert packed_alone(lengths) <= 505 < packed_alone(lengths, generations=0) - 5


def test_crossover_injects_whole_bins():
    lengths = [6, 5, 5, 4, 6, 4]
    islander = packing.Islander(lengths, 10, packing.Evolution(slack=0), 1)
    into = [(10, [1, 2]), (6, [0]), (8, [3, 5]), (6, [4])]
    source = [(10, [0, 3]), (10, [4, 5]), (10, [1, 2])]
    sizes = set()
    for _ in range(20):
        child = islander.crossed(into, source)
        assert sorted(d for _, held in child for d in held) == list(range(6))
        assert all(fill == sum(lengths[d] for d in held) <= 10 for fill, held in child)
        sizes.add(len(child))
    # What is injected and dissolved is chosen at random; no child is worse than both parents.
    assert min(sizes) == 3 and max(sizes) <= 4
    assert len(islander.evolve(into)) == 3


def test_bins_migrate_between_islands(spark):
    pick = random.Random(8)
    lengths = [pick.randint(200, 500) for _ in range(3000)]
    pieces = spark.createDataFrame([(n,) for n in lengths], "length int")
    packed = packing.pack(pieces, 1024, packing.Evolution(island=500))
    bins = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.count("*").alias("n")).collect()
    assert sum(b["n"] for b in bins) == 3000 and max(b["fill"] for b in bins) <= 1024
    assert len(bins) <= 0.98 * plain_best_fit(lengths)


def test_pack_refuses_what_cannot_fit(spark, nothing):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(11,)], "length int"), 10)
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(None,)], "length int"), 10)
    cut = packing.cut_documents(nothing, PATH, 16, 2)
    assert packing.pack(cut, 16).collect() == []


def test_cut_documents(awkward, reference):
    cut = packing.cut_documents(awkward, PATH, 16, 2).collect()
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in cut)
    expected = Counter()
    for key, text in TEXTS:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 2]
        stops = list(range(len(ids), 0, -16))[::-1]
        for piece, stop in enumerate(stops):
            start = stops[piece - 1] if piece else 0
            expected[key, piece, start, stop - start, bpe.pack(ids[start:stop])] += 1
    assert got == expected


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (300, 500), (500, 10**12), (400, 2**63), (50, 3)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe + 1, n, dtype=np.uint64))
    code = elias_fano.EliasFano(elias_fano.mapped(elias_fano.EliasFano.encode(values, universe)))
    assert (code.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe + 1, 200, dtype=np.uint64)])
    place, found = code.successor(asked)
    expected = np.searchsorted(values, asked)
    assert (place == expected).all()
    inside = expected < n
    assert (found[inside] == values[expected[inside]]).all()
    met = np.isin(asked, values)
    assert ((code.index(asked) >= 0) == met).all()
    assert (values[code.index(asked)[met]] == asked[met]).all()


def plain_scores(rows, trained):
    docs = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    words, pairs = Counter(), Counter()
    for (key, _), own in zip(rows, docs):
        if trained(key):
            words.update(own)
            pairs.update(zip([b"\n", *own[:-1]], own))
    types = Counter(h for h, _ in pairs)
    total, distinct = sum(words.values()), len(words)
    found = []
    for (key, _), own in zip(rows, docs):
        base = score = 0.0
        for h, w in zip([b"\n", *own[:-1]], own):
            p = (words[w] + 1) / (total + distinct + 1)
            base += math.log10(p)
            if words[h]:
                p = max(pairs[h, w] - 0.75, 0) / words[h] + 0.75 * types[h] / words[h] * p
            score += math.log10(p)
        found.append((key, trained(key), len(own), sum(words[w] > 0 for w in own), total, base, score))
    return sorted(found, key=repr)


def close(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5])
        assert a[6] == pytest.approx(b[6], abs=2e-4 * b[2])


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 300, "SHARD": 200, "SPLIT": 20, "WORD_BYTES": 500}])
def test_language_model(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ngram_lm, name, value)
    pick = random.Random(8)
    words = [f"w{min(int(pick.expovariate(0.1)), 80)}" for _ in range(200)]
    rows = [(i, " ".join(pick.choices(words, k=pick.randint(0, 60)))) for i in range(80)]
    rows += [(100 + i, rows[i][1] + " new" + str(i)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = ngram_lm.score_corpus(docs, F.col("doc_id") % 7 != 2).collect()
    close(sorted(map(tuple, got), key=repr), plain_scores(rows, lambda i: i % 7 != 2))


def test_language_model_of_awkward_rows(awkward, nothing):
    got = ngram_lm.score_corpus(awkward, F.col("doc_id") > 2).collect()
    key = lambda r: (repr(r[0]), r[2], r[5])
    expected = plain_scores(TEXTS, lambda i: i is not None and i > 2)
    close(sorted(map(tuple, got), key=key), sorted(expected, key=key))
    assert ngram_lm.score_corpus(nothing, F.lit(True)).collect() == []
    untrained = ngram_lm.score_corpus(awkward, F.lit(False)).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in untrained)


def test_crc32_agrees_with_the_contract(spark):
    row = spark.range(1).select(F.crc32(F.lit("123").cast("binary"))).first()
    assert row[0] == zlib.crc32(b"123")


def test_copies_and_rejected_texts_make_no_reference(spark, tmp_path):
    pick = random.Random(5)
    words = "the of and to in a is that for it was on are as with they at be this have".split()
    prose = [" ".join(pick.choices(words, k=pick.randint(110, 160))) for _ in range(40)]
    junk = " ".join(f"{w}{i}###" for i, w in enumerate(pick.choices(words, k=112)))
    short = " ".join(f"%%{i}" for i in range(40))
    rows = [(i, t, "en") for i, t in enumerate(prose)]
    rows += [(100 + i, junk, "en") for i in range(400)] + [(600, junk, "de"), (601, None, "en"), (602, junk, None)]
    rows += [(1000 + i, f"{short} {i}", "en") for i in range(300)]
    table = str(tmp_path / "docs")
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(4)
    docs.write.parquet(table)
    classes, counts = {}, {}
    for own, text in [("en", t) for t in prose] + [("en", junk), ("de", junk)]:
        classes[own] = classes.get(own, 0) + quality.class_counts(text.encode())
        counts.setdefault(own, Counter()).update(map(quality.stem, text.encode().split()))
    rules = quality.Rules(repeat_percent=100)
    for source in (docs, spark.read.parquet(table)):
        found = {(r["lang"], r["kind"], bytes(r["name"])): r["n"] for r in quality.language_references(source, rules).collect()}
        for own in ("en", "de"):
            assert [found[own, "class", c.encode()] for c in quality.CLASSES] == classes[own].tolist()
            assert found[own, "total", b""] == sum(counts[own].values())
        assert all(found["en", "word", w.encode()] == counts["en"][w.encode()] for w in words)
        only_english = source.filter("lang = 'en' AND text IS NOT NULL")
        kept = quality.judge_documents(only_english, rules).filter("kept").select("doc_id").collect()
        assert {r["doc_id"] for r in kept} == set(range(40))


def test_every_language_is_a_reference(spark):
    pick = random.Random(9)
    rows = []
    for own in range(6):
        words = [f"{chr(97 + own)}{i}" for i in range(20)]
        rows += [(own * 10 + i, " ".join(pick.choices(words, k=150)), f"l{own}") for i in range(8 - own)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    rules = quality.Rules(repeat_percent=100, languages=2)
    judged = {r["doc_id"]: r for r in quality.judge_documents(docs, rules).collect()}
    assert len(judged) == len(rows) and all(r["kept"] for r in judged.values())
    whole = quality.judge_documents(docs, quality.Rules(repeat_percent=100)).collect()
    assert {r["doc_id"]: r["word_distance"] for r in whole} == {k: r["word_distance"] for k, r in judged.items()}
