"""Quality rules with a distribution divergence.

Each language's reference is a pair of histograms over its distinct texts that pass the base rules:
character classes, and its most common words. Copies of a text add nothing, so no group of copies
becomes the reference of its language. A document is compared with every reference by Jensen-Shannon distance and judged
by the nearest one, so a wrong language column rejects nothing. Guards of least length keep short
texts, whose histograms say little, out of the comparison.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from topictally.llm.rows import numbered
from topictally.llm.workers import frees, small_batches
from topictally.session import scratch_folder

CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "symbol", "other")
SYMBOLS = b"#*$%&|<>"
#: Bytes of UTF-8 that do not begin a code point.
LATER_BYTES = bytes(range(128, 192))
STRIPPED = b".,;:!?\"'()"


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; distances lie between 0 and 1.

    ``common_words`` bounds a reference; ``class_words`` and ``word_words`` are the least numbers of
    words for the two comparisons. ``languages`` bounds how many references are compared at once.
    """

    least_words: int = 50
    repeat_percent: int = 50
    class_words: int = 50
    class_distance: float = 0.30
    word_words: int = 100
    word_distance: float = 0.42
    common_words: int = 64
    languages: int = 1000


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("symbol"), dtype=np.uint8)
    for name, members in (
        ("lower", range(97, 123)),
        ("upper", range(65, 91)),
        ("digit", range(48, 58)),
        ("space", (32, 9, 11, 12, 13)),
        ("line", (10,)),
        ("stop", STRIPPED + b"-"),
        ("other", range(128, 256)),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


TABLE = _class_table()


def class_counts(body: bytes) -> np.ndarray:
    return np.bincount(TABLE[np.frombuffer(body, dtype=np.uint8)], minlength=len(CLASSES))


def stem(word: bytes) -> bytes:
    """A word as references count it: lower case of ASCII, no punctuation around it."""
    return word.strip(STRIPPED).lower()


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances to base 2 of histograms, row by row, each with a positive sum."""
    p, q = (x / x.sum(axis=-1, keepdims=True) for x in (p, q))
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0).sum(axis=-1)
    return np.sqrt(np.maximum(0.0, (left + right) / 2))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    v = len(numbers)
    pairs = ids[:-1] * v + ids[1:]
    if v >= 2_000_000:  # three numbers would not fit into 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * v + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def repeated_lines(body: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in body.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def fails_base_rules(n: int, repeats: int, rules: Rules) -> bool:
    return n < rules.least_words or 100 * repeats > rules.repeat_percent * n


#: Rows whose marks lie in one bitmap, as Spark's bitmap functions have it.
MARKED_ROWS = 8 * 4096


def first_copies(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """One row (lang, body) of ``docs`` for each distinct text of each language, nulls left out.

    Texts are told apart by 256-bit digests. Only digests and row numbers are shuffled: a bit for each
    row says whether it is the first of its copies, and the bits travel to the texts.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "quality-copies")
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").cast("binary").alias("body")
    )
    rows = numbered(known, f"{folder}/docs")
    digest = F.unhex(F.sha2("body", 256)).alias("digest")
    first = rows.groupBy("lang", digest).agg(F.min("_row").alias("row"))
    marks = first.groupBy(F.expr(f"row div {MARKED_ROWS}").alias("block")).agg(
        F.bitmap_construct_agg(F.expr(f"row % {MARKED_ROWS}")).alias("marks")
    )
    marks.write.parquet(f"{folder}/marks")
    marks = F.broadcast(spark.read.parquet(f"{folder}/marks"))
    byte = f"conv(hex(substring(marks, int(_row % {MARKED_ROWS} div 8) + 1, 1)), 16, 10)"
    marked = rows.withColumn("block", F.expr(f"_row div {MARKED_ROWS}")).join(marks, "block")
    return marked.filter(f"getbit(bigint({byte}), int(_row % 8)) = 1").select("lang", "body")


#: Words a task counts before it hands its counts on.
HELD_WORDS = 100_000

COUNTED = "lang string, kind string, name binary, n bigint"


def language_references(
    docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Histograms of every language over its distinct texts: lang, kind, name, n.

    ``kind`` is "class" with the character classes, "total" with the number of words, or "word" with
    the ``common_words`` most common words (ties go by word). Documents without a language or text,
    and those that the base rules reject, add nothing. Tasks sum before the shuffle; an empty table gives no rows.
    """

    @frees
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("lang", pa.string()), ("kind", pa.string()), ("name", pa.binary()), ("n", pa.int64())]
        )
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def rows(own: str, kind: str, counts: dict[bytes, int]) -> pa.RecordBatch:
            columns = [own] * len(counts), [kind] * len(counts), list(counts), list(counts.values())
            arrays = [pa.array(c, t) for c, t in zip(columns, schema.types)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        def handed_on() -> Iterator[pa.RecordBatch]:
            for own, counts in classes.items():
                named = {c.encode(): int(n) for c, n in zip(CLASSES, counts)}
                yield rows(own, "class", named)
            for own, counter in words.items():
                stems: dict[bytes, int] = {}
                for word, n in counter.items():
                    word = stem(word)
                    stems[word] = stems.get(word, 0) + n
                yield rows(own, "total", {b"": sum(stems.values())})
                stems.pop(b"", None)
                yield rows(own, "word", stems)
            classes.clear()
            words.clear()

        for batch in batches:
            for own, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                split = body.split()
                if fails_base_rules(len(split), repeated_words(split), rules):
                    continue
                classes[own] = classes.get(own, 0) + class_counts(body)
                words.setdefault(own, Counter()).update(split)
                if sum(map(len, words.values())) > HELD_WORDS:
                    yield from handed_on()
        yield from handed_on()

    rows = first_copies(docs, text, lang)
    sums = rows.mapInArrow(count, COUNTED).groupBy("lang", "kind", "name").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "name")
    ranked = sums.withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= max(rules.common_words, len(CLASSES))).drop("place")


class Judge:
    """The features and the verdict of single texts, by given references."""

    def __init__(self, references: list[tuple], rules: Rules):
        self.rules = rules
        by_lang: dict[str, dict[str, dict[bytes, int]]] = {}
        for lang, kind, name, n in references:
            by_lang.setdefault(lang, {}).setdefault(kind, {})[bytes(name)] = n
        found = []
        for _, kinds in sorted(by_lang.items()):
            classes = [kinds.get("class", {}).get(c.encode(), 0) for c in CLASSES]
            top = sorted(kinds.get("word", {}).items(), key=lambda x: (-x[1], x[0]))
            top = top[: rules.common_words]
            rest = kinds.get("total", {}).get(b"", 0) - sum(n for _, n in top)
            if sum(classes) and (top or rest > 0):
                found.append((classes, top, max(rest, 0)))
        at_once = max(1, rules.languages)
        self.blocks = [self._block(found[i : i + at_once]) for i in range(0, len(found), at_once)]

    def _block(self, found: list[tuple]) -> tuple[np.ndarray, np.ndarray, dict[bytes, list[int]]]:
        """Histograms as rows of matrices, the rest of the words last, and the places of each word."""
        width = self.rules.common_words + 1
        words = np.zeros((len(found), width))
        places: dict[bytes, list[int]] = {}
        for row, (_, top, rest) in enumerate(found):
            for i, (word, n) in enumerate(top):
                words[row, i] = n
                places.setdefault(word, []).append(row * width + i)
            words[row, -1] = rest
        return np.array([classes for classes, _, _ in found], float), words, places

    def distances(self, body: bytes, words: list[bytes]) -> tuple[float, float]:
        """Distance of classes and of words to the nearest references; 0 without references."""
        if not self.blocks or not words:
            return 0.0, 0.0
        own = class_counts(body).astype(float)
        stems = Counter(map(stem, words))
        far = []
        for classes, reference, places in self.blocks:
            counts = np.zeros(reference.shape)
            index, values = [], []
            for word, n in stems.items():
                if at := places.get(word):
                    index += at
                    values += [n] * len(at)
            counts.flat[index] = values
            counts[:, -1] = len(words) - counts.sum(axis=1)
            far.append((distances(own, classes).min(), distances(counts, reference).min()))
        return float(min(c for c, _ in far)), float(min(w for _, w in far))

    def judge(self, body: bytes) -> tuple:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, distances, verdicts."""
        rules = self.rules
        words = body.split()
        n = len(words)
        chars = sum(len(w) for w in words) - len(body) + len(body.translate(None, LATER_BYTES))
        symbols = len(body) - len(body.translate(None, SYMBOLS))
        repeats = repeated_words(words)
        of_classes, of_words = self.distances(body, words)
        failed = fails_base_rules(n, repeats, rules)
        diverges = (n >= rules.class_words and of_classes > rules.class_distance) or (
            n >= rules.word_words and of_words > rules.word_distance
        )
        lines = repeated_lines(body)
        kept = not failed and not diverges
        return n, chars, symbols, lines, repeats, of_classes, of_words, failed, kept


JUDGED = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, class_distance double, word_distance double, "
    "base_failed boolean, kept boolean"
)


def judge_documents(
    docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang"
) -> DataFrame:
    """All columns of ``docs`` and what the rules say of each row.

    Words are runs of bytes that are no ASCII white space. ``base_failed`` is true with fewer than
    ``least_words`` words, or where more than ``repeat_percent`` per cent of the words lie in windows
    of three that occur twice or more. ``kept`` is false where that is so or the text diverges from
    the references. A null text counts as empty. A null language is no reference; rows without one
    are judged like others, and without any reference nothing diverges. Repeated rows are judged
    each. Columns of ``docs`` with a name of a result are replaced.
    """
    made = [part.split()[0] for part in JUDGED.split(", ")]
    small_batches(docs.sparkSession)
    rows = language_references(docs, rules, text, lang)
    # A few rows for each language.
    references = [tuple(r) for r in rows.collect()]

    @frees
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(references, rules).judge
        for batch in batches:
            *others, bodies = batch.columns
            judged = [judge(body.as_py() or b"") for body in bodies]
            columns = list(zip(*judged)) or [()] * len(made)
            arrays = [pa.array(c, t) for c, t in zip(columns, MADE_TYPES)]
            yield pa.RecordBatch.from_arrays([*others, *arrays], [*kept, *made])

    kept = [c for c in docs.columns if c not in made]
    types = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    body = F.col(text).cast("string").cast("binary").alias("_text_to_judge")
    return docs.select(*kept, body).mapInArrow(convert, ", ".join([*types, JUDGED]))


MADE_TYPES = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2


def drop_low_quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return judge_documents(docs, rules).filter("kept").select(*docs.columns)
