"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

The tree's root yields the leftmost pair of lowest rank. A merge updates at most three leaves, each in
logarithmic time, until no pair is left that the vocabulary can merge; so a word of n bytes takes
O(n log n), however long it is. The tokenizer's file gives ranks, ids and special tokens; nothing is
trained here.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from topictally.llm.workers import kept_by_worker

#: Fixed value: how byte-level BPE of this family cuts text into words.
WORDS = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: A cut before a space between two other characters never falls into a word.
LONE_SPACE = regex.compile(r"(?<=\S) (?=\S)")

#: Pieces of text whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 800_000
#: Bytes of text that are cut into pieces at once.
AT_ONCE = 4 << 20
#: Longer pieces are not remembered.
LONGEST_REMEMBERED = 200


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in the tokenizer's file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


#: More than any leaf, and the halves of a leaf or a merge.
NONE, RANK, PLACE = 1 << 62, ~0xFFFFFFFF, 0xFFFFFFFF


def is_plain(text: str) -> bool:
    """Whether a text's white space is single spaces and line ends between other characters.

    Texts with other characters that cannot be printed do not count as plain.
    """
    return (
        text.replace("\n", "").isprintable()
        and text[:1] not in ("", " ", "\n")
        and text[-1] not in " \n"
        and not any(pair in text for pair in ("  ", "\n\n", " \n", "\n "))
    )


class SegmentTree:
    """Least value over a row of leaves, with point updates; the root is ``nodes[1]``."""

    def __init__(self, values: list[int]):
        size = 1
        while size < len(values):
            size *= 2
        self.size = size
        nodes = self.nodes = [NONE] * size + values + [NONE] * (size - len(values))
        for i in range(size - 1, 0, -1):
            left, right = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = left if left <= right else right

    def update(self, leaf: int, value: int) -> None:
        nodes = self.nodes
        i = self.size + leaf
        nodes[i] = value
        i >>= 1
        while i:
            left, right = nodes[2 * i], nodes[2 * i + 1]
            least = left if left <= right else right
            if nodes[i] == least:
                break
            nodes[i] = least
            i >>= 1


class BytePairCoder:
    """Encodes and decodes with the vocabulary of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model, alphabet = stored["model"], byte_alphabet()
        ids = model["vocab"]
        self.first = [0] * 256
        names = {t["id"]: t["content"].encode() for t in stored["added_tokens"]}
        self.pieces = [b""] * (1 + max([*ids.values(), *names]))
        for token, i in ids.items():
            body = bytes(alphabet[c] for c in token)
            self.pieces[i] = body
            if len(body) == 1:
                self.first[body[0]] = i
        # (left id, right id) as one number -> rank and merged id as one number
        self.merges = {
            (ids[a] << 32) | ids[b]: (rank << 32) | ids[a + b]
            for rank, (a, b) in enumerate(
                pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]
            )
        }
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        for i, body in names.items():
            self.pieces[i] = body
        names = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.merge_keys = np.array(sorted(self.merges), dtype=np.int64)
        self.merge_values = np.array([self.merges[k] for k in self.merge_keys.tolist()])
        self._known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        first, get, none = self.first, self.merges.get, NONE
        ids = [first[b] for b in word]
        n = len(ids)
        if n == 1:
            return ids
        # A leaf holds its pair's rank, then its place, so equal ranks go to the leftmost pair.
        pairs = [get((a << 32) | b, none) for a, b in zip(ids, ids[1:])]
        tree = SegmentTree(
            [(pair & RANK) | i if pair < none else none for i, pair in enumerate(pairs)]
        )
        update, nodes = tree.update, tree.nodes
        following = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while (least := nodes[1]) < none:
            at = least & PLACE
            gone = following[at]
            # ``pairs`` holds the merge of each pair that still is one.
            ids[at] = own = pairs[at] & PLACE
            following[at] = right = following[gone]
            if right < n:
                before[right] = at
                pairs[at] = pair = get((own << 32) | ids[right], none)
                if nodes[tree.size + gone] < none:
                    update(gone, none)
                update(at, (pair & RANK) | at if pair < none else none)
            else:
                update(at, none)
            left = before[at]
            if left >= 0:
                pair = get((ids[left] << 32) | own, none)
                if pair < none or pairs[left] < none:
                    pairs[left] = pair
                    update(left, (pair & RANK) | left if pair < none else none)
        kept, at = [], 0
        while at < n:
            kept.append(ids[at])
            at = following[at]
        return kept

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged id of pairs of ids, NONE where there is no merge."""
        keys = (left << 32) | right
        place = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[place] == keys, self.merge_values[place], NONE)

    def _merge_alike(self, words: list[bytes], leaves: int) -> list[bytes]:
        """``merge`` for many words of up to ``leaves`` pairs, with a tree in each row of a matrix."""
        n = np.array(list(map(len, words)))
        rows = np.arange(len(words))
        places = np.arange(leaves + 1)
        alive = places < n[:, None]
        ids = np.zeros(alive.shape, dtype=np.int64)
        ids[alive] = np.array(self.first)[np.frombuffer(b"".join(words), dtype=np.uint8)]
        pairs = np.full((len(words), leaves), NONE, dtype=np.int64)
        both = alive[:, 1:]
        pairs[both] = self._look_up(ids[:, :-1][both], ids[:, 1:][both])
        nodes = np.full((len(words), 2 * leaves), NONE, dtype=np.int64)
        nodes[:, leaves:] = np.where(pairs < NONE, (pairs & RANK) | places[:-1], NONE)
        level = leaves
        while level > 1:
            lower = nodes[:, level : 2 * level]
            nodes[:, level // 2 : level] = np.minimum(lower[:, ::2], lower[:, 1::2])
            level //= 2
        following = np.broadcast_to(places + 1, alive.shape).copy()
        before = np.broadcast_to(places - 1, alive.shape).copy()

        def update(rows: np.ndarray, at: np.ndarray, pair: np.ndarray) -> None:
            pairs[rows, at] = pair
            node = at + leaves
            nodes[rows, node] = np.where(pair < NONE, (pair & RANK) | at, NONE)
            while node.size and node[0] > 1:
                node = node >> 1
                nodes[rows, node] = np.minimum(nodes[rows, 2 * node], nodes[rows, 2 * node + 1])

        rows = rows[nodes[:, 1] < NONE]
        while len(rows):
            at = nodes[rows, 1] & PLACE
            gone = following[rows, at]
            own = pairs[rows, at] & PLACE
            ids[rows, at] = own
            alive[rows, gone] = False
            right = following[rows, gone]
            following[rows, at] = right
            inner = right < n[rows]
            end = right[inner]
            before[rows[inner], end] = at[inner]
            pair = np.full(len(rows), NONE, dtype=np.int64)
            pair[inner] = self._look_up(own[inner], ids[rows[inner], end])
            update(rows[inner], gone[inner], np.full(len(end), NONE, dtype=np.int64))
            update(rows, at, pair)
            left = before[rows, at]
            inner = left >= 0
            held, left = rows[inner], left[inner]
            update(held, left, self._look_up(ids[held, left], own[inner]))
            rows = rows[nodes[rows, 1] < NONE]
        body = ids[alive].astype("<u4").tobytes()
        stops = (4 * np.cumsum(alive.sum(axis=1))).tolist()
        return [body[a:b] for a, b in zip([0, *stops], stops)]

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of many words."""
        out = [b""] * len(words)
        sizes = np.array(list(map(len, words)))
        least = 1
        for leaves in (4, 8, 16, 32):
            chosen = np.flatnonzero((sizes > least) & (sizes <= leaves + 1)).tolist()
            least = leaves + 1
            if chosen:
                for i, packed in zip(chosen, self._merge_alike([words[i] for i in chosen], leaves)):
                    out[i] = packed
        for i in np.flatnonzero((sizes == 1) | (sizes > least)).tolist():
            out[i] = pack(self.merge(words[i]))
        return out

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The packed ids of pieces that no word crosses the ends of."""
        known = self._known
        packed = list(map(known.get, pieces))
        missing = [i for i, p in enumerate(packed) if p is None]
        if not missing:
            return packed
        cut = [WORDS.findall(pieces[i]) for i in missing]
        words = list({w: None for own in cut for w in own if w not in known})
        found = dict(zip(words, self.merge_many([w.encode() for w in words])))
        for i, own in zip(missing, cut):
            packed[i] = b"".join([found.get(w) or known[w] for w in own])
        if len(known) >= REMEMBERED:
            known.clear()
        known.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST_REMEMBERED)
        known.update((pieces[i], packed[i]) for i in missing if len(pieces[i]) <= LONGEST_REMEMBERED)
        return packed

    def _plain(self, text: str) -> bytes:
        head, *rest = LONE_SPACE.split(text)
        return b"".join(self.ids_of([head, *[" " + p for p in rest]]))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.specials is None:
            return self._plain(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            if found.start() > at:
                out.append(self._plain(text[at : found.start()]))
            out.append(pack([self.special[found[0]]]))
            at = found.end()
        if not out:
            return self._plain(text)
        if at < len(text):
            out.append(self._plain(text[at:]))
        return b"".join(out)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of several texts, one after the other, and the number of ids of each.

        Texts of words with single spaces and line ends between them are cut all at once, and each
        distinct piece is looked up once.
        """
        plain = [is_plain(t) and not any(name in t for name in self.special) for t in texts]
        lines = pc.split_pattern(pa.array([t for t, p in zip(texts, plain) if p], pa.string()), "\n")
        pieces = pc.split_pattern(lines.flatten(), " ")
        of_text = np.diff(lines.offsets.to_numpy())
        of_line = np.diff(pieces.offsets.to_numpy())
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy().astype(np.int64) * 2 + 1
        code[np.cumsum(of_line) - of_line] -= 1  # a line's first piece has no space before it
        # Each line but a text's last ends in a line end.
        ends = np.ones(len(of_line), dtype=bool)
        ends[np.cumsum(of_text) - 1] = False
        code = np.insert(code, np.cumsum(of_line)[ends], 2 * len(words))
        met = np.zeros(2 * len(words) + 1, dtype=bool)
        met[code] = True
        met = np.flatnonzero(met)
        words.append("\n")
        packed = self.ids_of([(" " if c & 1 else "") + words[c >> 1] for c in met.tolist()])
        words.pop()
        sizes = np.zeros(2 * len(words) + 1, dtype=np.int64)
        begins = np.zeros(2 * len(words) + 1, dtype=np.int64)
        sizes[met] = [len(p) // 4 for p in packed]
        begins[met] = np.cumsum(sizes[met]) - sizes[met]
        pool = np.frombuffer(b"".join(packed), dtype="<i4")
        counts = sizes[code]
        stops = np.cumsum(counts)
        ids = pool[np.repeat(begins[code] - stops + counts, counts) + np.arange(int(counts.sum()))]
        # A text's pieces and line ends, then its ids.
        in_text = np.add.reduceat(of_line, np.cumsum(of_text) - of_text) if len(of_text) else of_text
        last = np.cumsum(in_text + of_text - 1) - 1
        n_ids = np.diff(stops[last], prepend=0) if len(last) else last
        if all(plain):
            return ids, n_ids
        parts, at = [], 0
        plainly = iter(n_ids.tolist())
        for text, was_plain in zip(texts, plain):
            if was_plain:
                size = next(plainly)
                parts.append(ids[at : at + size])
                at += size
            else:
                parts.append(np.frombuffer(self.encode(text), dtype="<i4"))
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


def pack(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def unpack(packed: bytes) -> list[int]:
    return memoryview(packed).cast("I").tolist()


def coder(path: str) -> BytePairCoder:
    """One coder for each worker and file."""
    return kept_by_worker(f"coder of {path}", lambda: BytePairCoder(path))


def code_documents(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Key, ``ids`` and the text that the ids give back, ``decoded``, of each row of ``docs``.

    ``path`` names the tokenizer's file on every executor. A special token's string in a text gives
    its id. A null text counts as empty and has no ids. Keys may be null or repeated; each row gives
    one row. Other columns are not read.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            for part in sliced(batch):
                keys, texts = part.columns
                ids, counts = own.encode_many([t or "" for t in texts.to_pylist()])
                ends = np.concatenate([[0], np.cumsum(counts)])
                listed = ids.tolist()
                decoded = [own.decode(listed[a:b]) for a, b in zip(ends, ends[1:])]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                columns = [keys, lists, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.col(text).cast("string").alias("_text_to_encode"))
    return rows.mapInArrow(convert, f"`{key}` {kind}, ids array<int>, decoded string")


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows whose last column has about ``AT_ONCE`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy()
    run = np.cumsum(sizes) // AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)
