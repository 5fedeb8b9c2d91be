"""The whole pipeline against plain versions of its stages, on the smallest tables."""

import zlib
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from topictally.llm import bpe, quality, secrets

from .test_dedup import brute_components, normal
from .test_other_operators import plain_spans
from .test_text_operators import plain_distance, plain_judgement

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


def plain_quality(rows):
    rules = quality.Rules()
    classes, stems = {}, {}
    for text, lang in {(text, lang) for _, text, lang in rows if lang and not plain_judgement(text)[-1]}:
        classes[lang] = classes.get(lang, 0) + quality.class_counts(text.encode())
        stems.setdefault(lang, Counter()).update(map(quality.stem, text.encode().split()))
    tops = {}
    for lang, counts in stems.items():
        named = sorted(((w, n) for w, n in counts.items() if w), key=lambda x: (-x[1], x[0]))
        tops[lang] = named[: rules.common_words], sum(counts.values())
    kept = []
    for row in rows:
        words = row[1].encode().split()
        if plain_judgement(row[1])[-1]:
            continue
        own, far = Counter(map(quality.stem, words)), []
        for lang, (top, total) in tops.items():
            counts = [own[w] for w, _ in top]
            of_words = plain_distance(
                [*counts, len(words) - sum(counts)],
                [*(n for _, n in top), total - sum(n for _, n in top)],
            )
            of_classes = plain_distance(
                quality.class_counts(row[1].encode()).tolist(), classes[lang].tolist()
            )
            far.append((of_classes, of_words))
        if min(c for c, _ in far) > rules.class_distance and len(words) >= rules.class_words:
            continue
        if min(w for _, w in far) > rules.word_distance and len(words) >= rules.word_words:
            continue
        kept.append(row)
    return kept


def plain_redaction(text):
    out, at = "", 0
    for start, _, rule, end in plain_spans(text, secrets.RULES):
        if start >= at:
            out += text[at:start] + f"[{rule}]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    rows = plain_quality(rows)
    best = {}
    for key, text, _ in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
        best.setdefault(normal(text), (key, text))
    rows = sorted(best.values())
    component = {key: c for key, _, c in brute_components(rows, 5, 80)}
    rows = [(key, text) for key, text in rows if component[key] == key]
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = set()
    for key, text in rows:
        ids = [*reference.encode(plain_redaction(text), add_special_tokens=False).ids, 2]
        stops = list(range(len(ids), 0, -1024))[::-1]
        for piece, stop in enumerate(stops):
            start = stops[piece - 1] if piece else 0
            expected.add((key, piece, start, stop - start, zlib.crc32(bpe.pack(ids[start:stop]))))
    got = corpus_pipeline.run(spark, str(TABLES)).collect()
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert {tuple(r[c] for c in columns) for r in got} == expected
    assert len(got) == len(expected)
    ends = Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 1024
    assert len(ends) <= -(-sum(ends.values()) // 1024) * 1.05
