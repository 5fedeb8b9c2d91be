"""Bigram language model as an Elias-Fano trie, trained on and applied to a whole corpus.

The trie has two levels. The first holds the words in the order of their hashes; a word's place in
it is its id. The second holds, for each context, its successors: sorted contexts, pointers to the
first successor of each, and the successors' ids, made monotone by adding the context's offset, all
in Elias-Fano code, with a quantised probability for each. A pair is found by a search for its
context and then for its successor relative to the context.

Both levels are cut into shards by hash, so no task and no driver holds the whole. Texts are read in
blocks of bounded size. A block asks each shard once for each of its distinct words or pairs; the
same question carries what the block counted in training texts, so counting and asking take one
shuffle for each level. The successors of very frequent contexts are spread over several shards.

Probabilities are interpolated with absolute discounting:

    p(w | h) = max(c(h, w) - D, 0) / c(h) + D * t(h) / c(h) * p(w)
    p(w) = (c(w) + 1) / (N + V + 1)

with t(h) the number of distinct successors of h. Each text begins after and ends with an end token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from topictally.llm.elias_fano import EliasFano, mapped
from topictally.llm.workers import small_batches
from topictally.session import scratch_folder

#: Tokens of a block and of a shard, about; occurrences of a context for each of its buckets.
BLOCK, SHARD, SPLIT = 2_000_000, 1_500_000, 1 << 22
#: Bytes of text for a shard of words, and the most buckets of a context.
WORD_BYTES, BUCKETS = 8 << 20, 1 << 12
DISCOUNT = 0.75
#: Steps of a tenth-logarithm in which probabilities are stored, rounded down; 0 is unseen.
STEP = 12 / 65534
END = b"\n"
MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(values: np.ndarray, kind: str) -> bytes:
    return zstandard.compress(values.astype(kind).tobytes(), 1)


def unpack(body: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(body), dtype=kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)), "<u8")


def unpack_sorted(body: bytes) -> np.ndarray:
    return np.cumsum(unpack(body, "<u8"), dtype=np.uint64)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


READ = "kind string, block string, shard int, one binary, two binary, three binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(),
    }
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    arrays = [pa.array(c, kinds[t]) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _with_keys(batch: pa.RecordBatch, keys: list | None, kind: pa.DataType) -> pa.RecordBatch:
    """The batch with a column ``keys``, filled in its first row only."""
    column = pa.array([keys] + [None] * (batch.num_rows - 1), pa.list_(kind))
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "keys"])


def _read_blocks(texts: DataFrame, shards: int) -> DataFrame:
    """Blocks of texts as numbers of their own words, and their words for each shard.

    A "text" row has the keys of a block's texts, the tokens of each, whether each is trained on, and
    the numbers of all tokens. A "words" row has sorted hashes and their counts in trained texts.
    Blocks are named by their task's number and their place in it.
    """
    kind = to_arrow_type(texts.schema["id"].dataType)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {END: 0}
        keys, sizes, trained, tokens = [], [], [], []
        held = made = 0

        def block() -> pa.RecordBatch:
            name = f"{TaskContext.get().partitionId()}-{made}"
            ids = np.concatenate(tokens)
            learned = np.repeat(np.array(trained, dtype=bool), sizes)
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers], dtype=np.uint64)
            order = np.argsort(hashes)
            place = np.empty(len(order), dtype=np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            ids = place[ids]
            hashes = hashes[order]
            counts = np.bincount(ids[learned], minlength=len(hashes))
            shard = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            cuts = np.flatnonzero(np.diff(shard)) + 1
            packed = pack(np.array(sizes), "<u4"), pack(np.array(trained), "u1"), pack(ids, "<u4")
            out = [("text", name, None, *packed)]
            for s, h, c in zip(
                np.split(shard, cuts), np.split(hashes, cuts), np.split(counts, cuts)
            ):
                out.append(("words", name, int(s[0]), pack_sorted(h), pack(c, "<u4"), None))
            whole = _with_keys(_batch(out, READ), list(keys), kind)
            for x in (keys, sizes, trained, tokens):
                x.clear()
            numbers.clear()
            numbers[END] = 0
            return whole

        for batch in batches:
            for key, learned, body in zip(*batch.columns):
                words = body.as_py().lower().split()
                own = [numbers.setdefault(w, len(numbers)) for w in words]
                own.append(0)
                keys.append(key.as_py())
                sizes.append(len(own))
                trained.append(learned.as_py())
                tokens.append(np.array(own, dtype=np.uint32))
                held += len(own)
                if held >= BLOCK:
                    yield block()
                    held, made = 0, made + 1
        if keys:
            yield block()

    return texts.mapInArrow(read, f"{READ}, {_keys(texts.schema['id'].dataType)}")


def _keys(kind: DataType) -> str:
    return f"keys array<{kind.simpleString()}>"


NAMED = "kind string, block string, shard int, known bigint, tokens bigint, one binary, two binary"


def _name_words(words: DataFrame, shards: int) -> DataFrame:
    """The first level: answers ids and counts of each block's words; one row of sums a shard.

    An id is a word's place in its shard times the number of shards, plus the shard. Words that no
    trained text has get the id after the last.
    """

    def name(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        blocks = table.column("block").to_pylist()
        hashes = [unpack_sorted(x.as_py()) for x in table.column("one")]
        counts = [unpack(x.as_py(), "<u4") for x in table.column("two")]
        every, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), minlength=len(every)).astype(np.int64)
        known = total > 0
        floor = np.uint64(-(-(shard << 32) // shards) << 32)
        body = EliasFano.encode(every[known] - floor, ((1 << 32) // shards + 1) << 32)
        level, held = EliasFano(mapped(body)), total[known]
        sums = int(known.sum()), int(total.sum())
        rows = [("level", None, shard, *sums, body, pack(held, "<u4"))]
        for block, asked in zip(blocks, hashes):
            at = level.index(asked - floor)
            found = at >= 0
            ids = np.where(found, at * shards + shard, -1)
            own = np.where(found, held[np.maximum(at, 0)] if len(held) else 0, 0)
            rows.append(("names", block, shard, None, None, pack(ids, "<i8"), pack(own, "<u4")))
        return pa.Table.from_batches([_batch(rows, NAMED)])

    return words.groupBy("shard").applyInArrow(name, NAMED)


@dataclass(frozen=True)
class Totals:
    """Distinct words and tokens of the trained texts."""

    words: int
    tokens: int

    @property
    def split(self) -> int:
        """Occurrences of a context for each of its buckets."""
        return max(SPLIT, -(-self.tokens // (BUCKETS - 1)))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1.0) / (self.tokens + 1.0 * (self.words + 1))


class BlockOfTexts:
    """A block's tokens with the first level's answers."""

    def __init__(self, table: pa.Table):
        kinds = table.column("kind").to_pylist()
        at = kinds.index("text")
        one, two, three = (table.column(c) for c in ("one", "two", "three"))
        self.keys = table.column("keys").combine_chunks()[at].values
        self.sizes = unpack(one[at].as_py(), "<u4").astype(np.int64)
        self.trained = unpack(two[at].as_py(), "u1").astype(bool)
        self.tokens = unpack(three[at].as_py(), "<u4").astype(np.int64)
        shards = table.column("shard").to_pylist()
        names = sorted((shards[i], i) for i, kind in enumerate(kinds) if kind == "names")
        # Answers lie in the order of the shards, which is that of the hashes.
        self.ids = np.concatenate([unpack(one[i].as_py(), "<i8") for _, i in names])
        self.counts = np.concatenate([unpack(two[i].as_py(), "<u4") for _, i in names]).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Own numbers of each token's context and of the token; a text begins after an end."""
        starts = _starts(self.sizes)
        context = np.empty_like(self.tokens)
        context[1:] = self.tokens[:-1]
        context[starts] = self.tokens[starts + self.sizes - 1]
        return context, self.tokens

    def known_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) numbers with known words, and each token's place among them.

        The place is -1 where either word is unknown.
        """
        context, word = self.pairs()
        known = (self.ids[context] >= 0) & (self.ids[word] >= 0)
        keys = context[known] * len(self.ids) + word[known]
        distinct, place = np.unique(keys, return_inverse=True)
        places = np.full(len(word), -1, dtype=np.int64)
        places[known] = place
        return distinct // len(self.ids), distinct % len(self.ids), places

    def questions(self, totals: Totals, shards: int) -> list[tuple]:
        """For each shard of the second level: contexts, their pairs, and places of both here.

        Each context is asked in all its buckets, so that its distinct successors add up.
        """
        context, word, _ = self.known_pairs()
        buckets = 1 + self.counts // totals.split
        bucket = mixed(self.ids[word].astype(np.uint64)) % buckets[context].astype(np.uint64)
        pair_keys = self.ids[context].astype(np.uint64) * np.uint64(BUCKETS) + bucket
        # Also contexts that only stand before unknown words.
        own = np.unique(self.pairs()[0])
        own = own[self.ids[own] >= 0]
        spread = np.repeat(own, buckets[own])
        number = np.arange(len(spread)) - np.repeat(_starts(buckets[own]), buckets[own])
        keys = self.ids[spread].astype(np.uint64) * np.uint64(BUCKETS) + number.astype(np.uint64)
        key_shard = shard_of(keys, shards)
        pair_shard = shard_of(pair_keys, shards)
        key_order = np.lexsort((keys, key_shard))
        pair_order = np.lexsort((self.ids[word], pair_keys, pair_shard))
        out = []
        key_ends = np.searchsorted(key_shard[key_order], np.arange(shards + 1))
        pair_ends = np.searchsorted(pair_shard[pair_order], np.arange(shards + 1))
        for s in range(shards):
            k = key_order[key_ends[s] : key_ends[s + 1]]
            p = pair_order[pair_ends[s] : pair_ends[s + 1]]
            if len(k):
                counts = np.searchsorted(pair_keys[p], keys[k], "right") - np.searchsorted(
                    pair_keys[p], keys[k], "left"
                )
                out.append((s, keys[k], self.counts[spread[k]], counts, self.ids[word[p]], spread[k], p))
        return out


def mixed(values: np.ndarray) -> np.ndarray:
    values = values * MIX
    return values ^ (values >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((mixed(keys) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


ASKED = "block string, shard int, contexts binary, counts binary, sizes binary, words binary, seen binary"


def _ask_pairs(blocks: DataFrame, totals: Totals, shards: int) -> DataFrame:
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = BlockOfTexts(table)
        _, _, places = block.known_pairs()
        learned = np.repeat(block.trained, block.sizes) & (places >= 0)
        seen = np.bincount(places[learned], minlength=int(places.max(initial=-1)) + 1)
        rows = [
            (key[0].as_py(), shard, pack_sorted(keys), pack(counts, "<u4"), pack(sizes, "<u4"),
             pack(words, "<u8"), pack(seen[p], "<u4"))
            for shard, keys, counts, sizes, words, _, p in block.questions(totals, shards)
        ]
        return pa.Table.from_batches([_batch(rows, ASKED)])

    return blocks.groupBy("block").applyInArrow(ask, ASKED)


class PairLevel:
    """The second level of a shard."""

    def __init__(self, parts: dict[str, bytes]):
        self.contexts = EliasFano(mapped(parts["contexts"]))
        self.pointers = EliasFano(mapped(parts["pointers"]))
        self.successors = EliasFano(mapped(parts["successors"]))
        self.codes = np.frombuffer(mapped(parts["codes"]), dtype="<u2")
        self.span = int.from_bytes(parts["span"], "little")

    @classmethod
    def encode(cls, keys, words, counts, totals) -> dict[str, bytes]:
        """Bytes of the level of sorted distinct (key, word) pairs with counts and contexts' totals."""
        contexts, first = np.unique(keys, return_index=True)
        pointers = np.append(first, len(keys)).astype(np.uint64)
        span = int(words.max(initial=0)) + 1
        place = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(pointers).astype(np.int64))
        # Relative to its context a successor is a number below the span.
        monotone = place * np.uint64(span) + words
        share = np.maximum(counts - DISCOUNT, 1e-12) / totals
        codes = 1 + np.ceil(np.minimum(-np.log10(share) / STEP, 65534 - 1))
        return {
            "contexts": EliasFano.encode(contexts, int(contexts[-1]) if len(contexts) else 0),
            "pointers": EliasFano.encode(pointers, len(keys)),
            "successors": EliasFano.encode(monotone, max(1, len(contexts)) * span),
            "codes": codes.astype("<u2").tobytes(),
            "span": span.to_bytes(8, "little"),
        }

    def find(self, keys: np.ndarray, sizes: np.ndarray, words: np.ndarray):
        """Distinct successors of each context, and the code of each of its words (0: unseen)."""
        place = self.contexts.index(keys)
        here = np.maximum(place, 0)
        types = np.zeros(len(keys), dtype=np.int64)
        if self.contexts.n:
            ends = self.pointers.get(here + 1).astype(np.int64)
            types = np.where(place >= 0, ends - self.pointers.get(here).astype(np.int64), 0)
        owner = np.repeat(place, sizes)
        asked = np.flatnonzero((owner >= 0) & (words < self.span))
        at = self.successors.index(owner[asked].astype(np.uint64) * np.uint64(self.span) + words[asked])
        codes = np.zeros(len(words), dtype=np.uint16)
        codes[asked[at >= 0]] = self.codes[at[at >= 0]]
        return types, codes


ANSWERED = "kind string, block string, shard int, one binary, two binary, three binary, four binary, five binary"


def _answer_pairs(asked: DataFrame) -> DataFrame:
    """The second level: builds each shard from the blocks' counts and answers the blocks from it."""

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        blocks = table.column("block").to_pylist()
        contexts = [unpack_sorted(x.as_py()) for x in table.column("contexts")]
        totals = [unpack(x.as_py(), "<u4") for x in table.column("counts")]
        sizes = [unpack(x.as_py(), "<u4") for x in table.column("sizes")]
        words = [unpack(x.as_py(), "<u8") for x in table.column("words")]
        seen = [unpack(x.as_py(), "<u4") for x in table.column("seen")]
        keys = np.concatenate([np.repeat(c, n) for c, n in zip(contexts, sizes)])
        of_keys = np.concatenate([np.repeat(t, n) for t, n in zip(totals, sizes)])
        every, counts = np.concatenate(words), np.concatenate(seen).astype(np.int64)
        met = counts > 0
        keys, of_keys, every, counts = keys[met], of_keys[met], every[met], counts[met]
        order = np.lexsort((every, keys))
        keys, of_keys, every, counts = keys[order], of_keys[order], every[order], counts[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (every[1:] != every[:-1])
        first = np.flatnonzero(new)
        sums = np.add.reduceat(counts, first) if len(first) else counts
        parts = PairLevel.encode(keys[first], every[first], sums, of_keys[first])
        level = PairLevel(parts)
        rows = [("level", None, shard, *(parts[p] for p in ("contexts", "pointers", "successors", "codes", "span")))]
        for block, c, n, w in zip(blocks, contexts, sizes, words):
            types, codes = level.find(c, n, w)
            rows.append(("answers", block, shard, pack(types, "<u4"), pack(codes, "<u2"), None, None, None))
        return pa.Table.from_batches([_batch(rows, ANSWERED)])

    return asked.groupBy("shard").applyInArrow(answer, ANSWERED)


SCORED = "trained boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score_blocks(blocks: DataFrame, totals: Totals, shards: int, key: str, kind: DataType) -> DataFrame:
    names = [key, *(c.split()[0] for c in SCORED.split(", "))]

    def score(table: pa.Table) -> pa.Table:
        block = BlockOfTexts(table)
        kinds = table.column("kind").to_pylist()
        number = table.column("shard").to_pylist()
        answers = {number[i]: i for i, kind in enumerate(kinds) if kind == "answers"}
        context, word, places = block.known_pairs()
        types = np.zeros(len(block.ids), dtype=np.int64)
        codes = np.zeros(len(context), dtype=np.int64)
        for shard, _, _, _, _, own, pairs in block.questions(totals, shards):
            at = answers[shard]
            np.add.at(types, own, unpack(table.column("one")[at].as_py(), "<u4").astype(np.int64))
            codes[pairs] = unpack(table.column("two")[at].as_py(), "<u2")
        base = totals.base(block.counts)
        before, now = block.pairs()
        plain = base[now]
        share = np.where(codes > 0, 10.0 ** (-(codes - 1) * STEP), 0.0)
        seen = block.counts[before]
        left = np.where(seen > 0, DISCOUNT * types[before] / np.maximum(seen, 1), 1.0)
        direct = np.zeros(len(now))
        direct[places >= 0] = share[places[places >= 0]]
        # An unknown context has no successors and leaves everything to the single word.
        model = np.log10(direct + left * plain)
        starts = _starts(block.sizes)
        columns = [
            block.keys,
            pa.array(block.trained),
            pa.array(block.sizes),
            pa.array(np.add.reduceat((block.counts[now] > 0).astype(np.int64), starts)),
            pa.array(np.add.reduceat(np.log10(plain), starts)),
            pa.array(np.add.reduceat(model, starts)),
        ]
        return pa.Table.from_arrays(columns, names)

    return blocks.groupBy("block").applyInArrow(score, f"`{key}` {kind.simpleString()}, {SCORED}")


def score_corpus(
    docs: DataFrame, trained: Column, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Train on the rows where ``trained`` is true and score every row.

    ASCII letters are lower-cased; tokens are runs of bytes that are no ASCII white space, then one
    end. A null text counts as empty and is the end alone; a null ``trained`` counts as false. Keys
    may be null or repeated; each row gives one row. Other columns are not read. Without trained rows
    all words are unknown and all have the same probability. An empty table gives no rows. Words are
    told apart by 64-bit hashes.

    Returns key, ``trained``, ``n_tokens``, ``n_known`` (tokens that trained texts have),
    ``train_tokens``, ``base_score`` (of single words) and ``score``, logarithms to base 10. The
    model's levels stay in the scratch folder below the shared one until the session ends.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "ngram-lm")
    small_batches(spark)
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    texts = docs.select(
        F.col(key).alias("id"), F.coalesce(trained, F.lit(False)).alias("trained"), body.alias("body")
    )
    kind = texts.schema["id"].dataType
    size = texts.agg(F.sum(F.length("body"))).first()[0] or 0
    word_shards = 1 + size // WORD_BYTES
    _read_blocks(texts, word_shards).write.partitionBy("kind").parquet(f"{folder}/blocks")
    read = spark.read.schema(f"{READ}, {_keys(kind)}").parquet(f"{folder}/blocks")
    words = read.filter("kind = 'words'").select("shard", "block", "one", "two")
    _name_words(words, word_shards).write.partitionBy("kind").parquet(f"{folder}/words")
    names = spark.read.schema(NAMED).parquet(f"{folder}/words")
    sums = names.filter("kind = 'level'").agg(F.sum("known"), F.sum("tokens")).first()
    totals = Totals(sums[0] or 0, sums[1] or 0)

    def as_blocks(rows: DataFrame) -> DataFrame:
        none = F.lit(None)
        three = F.col("three") if "three" in rows.columns else none.cast("binary").alias("three")
        keys = none.cast(read.schema["keys"].dataType).alias("keys")
        return rows.select("kind", "block", "shard", "one", "two", three, keys)

    own = read.filter("kind = 'text'").select("kind", "block", "shard", "one", "two", "three", "keys")
    blocks = own.union(as_blocks(names.filter("kind = 'names'")))
    shards = 1 + totals.tokens // SHARD
    asked = _ask_pairs(blocks, totals, shards)
    _answer_pairs(asked).write.partitionBy("kind").parquet(f"{folder}/pairs")
    answers = spark.read.schema(ANSWERED).parquet(f"{folder}/pairs").filter("kind = 'answers'")
    scored = _score_blocks(blocks.union(as_blocks(answers)), totals, shards, key, kind)
    return scored.withColumn("train_tokens", F.lit(totals.tokens).cast("bigint")).select(
        key, "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
