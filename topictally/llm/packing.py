"""Best-fit packing by a grouping genetic algorithm on islands.

A gene is a whole bin. Crossover injects well-filled bins of one parent into another, removes the
bins that hold one of their documents, and best-fits the documents this displaced: a bin gets the
one or two of them that leave the least room in it. An island is one group of bounded size, whose
search stops when generations bring no gain. After each round the bins that are full but for a few
tokens are settled. All other bins of an island's best packing migrate, as whole bins, to fewer
islands: there they are an individual of the first population, and crossover injects its bins into
packings made anew of all that came together. Nothing is ever held in one place.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from topictally.llm.bpe import WORDS, byte_alphabet
from topictally.llm.rows import apart_from
from topictally.llm.workers import frees, give_back, kept_by_worker, small_batches
from topictally.session import scratch_folder


@dataclass(frozen=True)
class Evolution:
    """Sizes of the search.

    ``slack`` is how many tokens a settled bin may lack, ``patience`` the generations without gain
    after which an island stops.
    """

    island: int = 8192
    population: int = 4
    generations: int = 80
    patience: int = 8
    rounds: int = 6
    slack: int = 2
    seed: int = 7


Bin = tuple[int, list[int]]  # fill, documents


class Islander:
    """Evolves packings of one island's documents."""

    def __init__(self, lengths: list[int], capacity: int, evolution: Evolution, seed: int):
        self.lengths, self.capacity, self.evolution = lengths, capacity, evolution
        self.random = random.Random(seed)

    def fit(self, bins: list[Bin], documents: list[int]) -> list[Bin]:
        """Put documents, in the given order, into the fullest bin that has room, or a new one."""
        lengths, capacity = self.lengths, self.capacity
        room: list[list[Bin]] = [[] for _ in range(capacity + 1)]
        mask = 0
        full = []
        for one in bins:
            left = capacity - one[0]
            if left:
                room[left].append(one)
                mask |= 1 << left
            else:
                full.append(one)
        for document in documents:
            length = lengths[document]
            wide = mask >> length
            if wide:
                left = length + (wide & -wide).bit_length() - 1
                fill, held = room[left].pop()
                if not room[left]:
                    mask ^= 1 << left
                one = (fill + length, [*held, document])
            else:
                left, one = capacity, (length, [document])
            left -= length
            if left:
                room[left].append(one)
                mask |= 1 << left
            else:
                full.append(one)
        return full + [one for same in room for one in same]

    def fit_sets(self, bins: list[Bin], documents: list[int]) -> list[Bin]:
        """Best fit of one or two documents at a time: the fullest bins first, then new ones.

        A new bin begins with the longest document left. What is put into a bin is what leaves the
        least room in it, and its rest is filled in the same way.
        """
        lengths, capacity = self.lengths, self.capacity
        waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
        mask = 0
        for document in documents:
            waiting[lengths[document]].append(document)
            mask |= 1 << lengths[document]

        def best(left: int) -> tuple[int, ...]:
            """The one or two lengths with the largest sum up to ``left``."""
            fits = mask & ((2 << left) - 1)
            if not fits:
                return ()
            high = one = fits.bit_length() - 1
            found: tuple[int, ...] = (one,)
            while high < left and one * 2 > high:
                other = mask & ((2 << min(left - one, one)) - 1)
                if other & (1 << one) and len(waiting[one]) < 2:
                    other ^= 1 << one
                if other:
                    both = one + other.bit_length() - 1
                    if both > high:
                        high, found = both, (one, both - one)
                fits ^= 1 << one
                if not fits:
                    break
                one = fits.bit_length() - 1
            return found

        made = []
        begun = sorted(bins, reverse=True, key=lambda one: one[0])
        at = 0
        while at < len(begun) or mask:
            if at < len(begun):
                fill, held = begun[at]
                held, at = list(held), at + 1
            else:
                fill, held = 0, []
            chosen = best(capacity - fill) if held else (mask.bit_length() - 1,)
            while chosen:
                for length in chosen:
                    held.append(waiting[length].pop())
                    if not waiting[length]:
                        mask ^= 1 << length
                    fill += length
                chosen = best(capacity - fill)
            made.append((fill, held))
        return made

    def first(self, noise: float) -> list[Bin]:
        """A packing from scratch, longest documents first but for some noise."""
        lengths, span = self.lengths, noise * self.capacity
        order = sorted(
            range(len(lengths)), key=lambda d: -lengths[d] - span * self.random.random()
        )
        return self.fit([], order)

    def fitness(self, bins: list[Bin]) -> tuple[int, float]:
        """Few bins first, then bins that are full or empty rather than even."""
        return -len(bins), sum(fill * fill for fill, _ in bins)

    def crossed(self, into: list[Bin], source: list[Bin]) -> list[Bin]:
        """``into`` with whole well-filled bins of ``source``, and some of its own bins dissolved."""
        nearly = self.capacity - self.evolution.slack
        well = sum(fill for fill, _ in source) / len(source)
        injected = [one for one in source if one[0] >= well and self.random.random() < 0.5]
        taken = bytearray(len(self.lengths))
        for _, held in injected:
            for document in held:
                taken[document] = 1
        kept, displaced = list(injected), []
        for one in into:
            if any(taken[d] for d in one[1]):
                displaced += [d for d in one[1] if not taken[d]]
            elif one[0] >= nearly or self.random.random() < 0.5:
                kept.append(one)
            else:
                displaced += one[1]
        return self.fit_sets(kept, displaced)

    def evolve(self, immigrants: list[Bin] = ()) -> list[Bin]:
        """The best packing found; ``immigrants``, bins of all documents, are one to begin with."""
        fewest = -(-sum(self.lengths) // self.capacity)
        people = [list(immigrants)] if immigrants else []
        makers = [lambda: self.first(0.0), lambda: self.fit_sets([], list(range(len(self.lengths))))]
        while len(people) < self.evolution.population:
            people.append(makers.pop(0)() if makers else self.first(0.05 * len(people)))
        people.sort(key=self.fitness, reverse=True)
        idle = 0
        for _ in range(self.evolution.generations):
            if len(people[0]) <= fewest or idle == self.evolution.patience:
                break
            parents = people[: max(2, len(people) // 2)]
            children = []
            while len(parents) + len(children) < self.evolution.population:
                into, source = self.random.sample(parents, 2)
                children.append(self.crossed(into, source))
            before = self.fitness(people[0])
            people = sorted([*parents, *children], key=self.fitness, reverse=True)
            idle = 0 if self.fitness(people[0]) > before else idle + 1
        return people[0]


PLACED = "item bigint, length bigint, sequence_id bigint, offset bigint, settled boolean"


def _evolve_islands(items: DataFrame, islands: int, capacity: int, evolution, last: bool, turn: int):
    """One round: rows (item, length, home) to rows with their bin and place in it.

    ``home`` is the bin with which an item comes, null in the first round.
    """
    schema = pa.schema(
        [
            ("item", pa.int64()),
            ("length", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
            ("settled", pa.bool_()),
        ]
    )

    def evolve(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("item").to_numpy())
        items = table.column("item").to_numpy()[order]
        lengths = table.column("length").to_numpy()[order]
        seed = evolution.seed * 1_000_003 + turn * 7919 + key[0].as_py()
        islander = Islander(lengths.tolist(), capacity, evolution, seed)
        immigrants: dict[int, Bin] = {}
        if turn:
            for i, home in enumerate(table.column("home").to_numpy()[order].tolist()):
                fill, held = immigrants.get(home, (0, []))
                immigrants[home] = (fill + islander.lengths[i], [*held, i])
        bins = islander.evolve(list(immigrants.values()))
        members = np.array([d for _, held in bins for d in held], dtype=np.int64)
        counts = np.array([len(held) for _, held in bins])
        fills = np.array([fill for fill, _ in bins])
        starts = np.cumsum(counts) - counts
        own = lengths[members]
        before = np.cumsum(own) - own
        firsts = np.minimum.reduceat(items[members], starts)
        return pa.Table.from_arrays(
            [
                pa.array(items[members]),
                pa.array(own),
                pa.array(np.repeat(firsts, counts)),
                pa.array(before - np.repeat(before[starts], counts)),
                pa.array(np.repeat(last | (fills >= capacity - evolution.slack), counts)),
            ],
            schema=schema,
        )

    # Mixed anew each round, by whole bins, so that these meet others.
    island = F.pmod(F.xxhash64(F.coalesce("home", "item"), F.lit(turn)), F.lit(islands))
    spread = items.select("item", "length", "home", island.alias("island"))
    # Islands are few bytes and much work, so Spark must not join them by their bytes.
    parts = min(islands, 4 * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = spread.repartition(parts, "island")
    return spread.groupBy("island").applyInArrow(evolve, PLACED)


@apart_from("_item")
def pack(pieces: DataFrame, capacity: int, evolution: Evolution = Evolution()) -> DataFrame:
    """All rows of ``pieces`` with ``sequence_id`` and ``offset``, in few sequences.

    ``pieces`` has a column ``length``; rows without a length, or with one above ``capacity``, are an
    error, and rows of length 0 lie at offset 0 of a sequence of their own. Repeated rows are packed
    each. All other columns are handed through; those named like a result are replaced. An empty
    table gives no rows. Offsets in a sequence are gapless from 0.
    """
    spark = pieces.sparkSession
    folder = scratch_folder(spark, "packing")
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_item")]
    numbered = pieces.select(*kept, F.monotonically_increasing_id().alias("_item"))
    numbered.write.parquet(f"{folder}/pieces")
    numbered = spark.read.parquet(f"{folder}/pieces")
    length = F.col("length").cast("bigint")
    wrong = numbered.filter(length.isNull() | (length > capacity) | (length < 0))
    if not wrong.isEmpty():
        raise ValueError(f"a piece has no length from 0 to {capacity}")
    alone = F.lit(None).cast("bigint").alias("home")
    items = numbered.select(F.col("_item").alias("item"), length.alias("length"), alone)
    items = items.filter((F.col("length") < capacity) & (F.col("length") > 0))
    left, turn = items.count(), 0
    settled = None
    while left:
        islands = -(-left // evolution.island)
        last = islands == 1 or turn == evolution.rounds - 1
        placed = _evolve_islands(items, islands, capacity, evolution, last, turn)
        place = f"{folder}/round-{turn}"
        placed.write.partitionBy("settled").parquet(place)
        placed = spark.read.schema(PLACED).parquet(place)
        done = placed.filter("settled").select("item", "sequence_id", "offset")
        settled = done if settled is None else settled.union(done)
        items = placed.filter("NOT settled").select("item", "length", F.col("sequence_id").alias("home"))
        left, turn = items.count(), turn + 1
    if settled is None:
        alone = F.col("_item").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
        return numbered.select(*kept, *alone)
    settled = settled.withColumnRenamed("item", "_item")
    return numbered.join(settled, "_item", "left").select(
        *kept,
        F.coalesce("sequence_id", "_item").alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("bigint")).alias("offset"),
    )


def _encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer of a file. Its ids are the ranks of its merges."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    alphabet = byte_alphabet()
    special = {t["content"]: t["id"] for t in stored["added_tokens"]}
    ranks = {
        bytes(alphabet[c] for c in token): i
        for token, i in stored["model"]["vocab"].items()
        if token not in special
    }
    made = tiktoken.Encoding(
        path, pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens=special
    )
    del stored, alphabet, special, ranks
    give_back()
    return made


def cut_documents(
    docs: DataFrame,
    path: str,
    capacity: int,
    end: int,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """The pieces of every row's ids, with ``end`` after the last: key, piece, start, length, ids.

    A text of more than ``capacity`` ids is cut; all pieces but the first are full. ``ids`` is binary,
    little-endian unsigned 32-bit. A null text counts as empty and has one piece, the end. Keys may
    be null or repeated. ``path`` names the tokenizer's file on every executor. Other columns are
    not read.
    """
    names = [key, "piece", "start", "length", "ids"]
    small_batches(docs.sparkSession)

    @frees
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_by_worker(f"ids of {path}", lambda: _encoding(path)).encode_to_numpy
        for batch in batches:
            rows, number, start, length, ids = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                body = encode(text.as_py() or "", allowed_special="all")
                own = np.append(body, np.uint32(end)).astype("<u4").tobytes()
                total = len(own) // 4
                cuts = [0, *range(total % capacity or capacity, total + 1, capacity)]
                for i, (at, stop) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(row)
                    number.append(i)
                    start.append(at)
                    length.append(stop - at)
                    ids.append(own[4 * at : 4 * stop])
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            counted = [pa.array(x, pa.int64()) for x in (start, length)]
            columns = [keys, pa.array(number, pa.int32()), *counted, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.col(text).cast("string").alias("_text_to_cut"))
    return rows.mapInArrow(
        convert, f"`{key}` {kind}, piece int, start bigint, length bigint, ids binary"
    )
