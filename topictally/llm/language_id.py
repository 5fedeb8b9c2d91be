"""Language ID by a byte convolutional network, trained in numpy on labelled text.

A window is a fixed number of bytes. Filters of several widths slide over it, each keeps its largest
value, and a softmax over these gives the languages. A filter on bytes is a sum of one table row for
each byte under it, so embedding and filter are one table and nothing is multiplied at inference.
A text's language comes from the mean log-probabilities of all its windows.

The network is fitted on a bounded sample of labelled rows; its size does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

UNDETERMINED = "und"


@dataclass(frozen=True)
class Network:
    """Sizes of the network and of its training.

    ``rows_per_language``, ``rows`` (of all labels together, but one of each at least) and ``windows_per_row``
    bound the labelled sample. Every label is learned.
    """

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    rows_per_language: int = 400
    windows_per_row: int = 4
    rows: int = 100_000
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


def windows_of(body: bytes, size: int) -> np.ndarray:
    """All of a text as rows of ``size`` bytes, the last filled up with spaces."""
    body = b" " + body.lower()
    short = -len(body) % size
    return np.frombuffer(body + b" " * short, dtype=np.uint8).reshape(-1, size)


class Model:
    """Tables of the filters and the softmax layer."""

    def __init__(self, labels: list[str], network: Network):
        self.labels, self.network = labels, network
        rng = np.random.default_rng(network.seed)
        f = network.filters
        self.tables = [
            [rng.normal(0, 0.3, (256, f)).astype(np.float32) for _ in range(width)]
            for width in network.widths
        ]
        self.bias = np.zeros(f * len(network.widths), np.float32)
        self.out = rng.normal(0, 0.1, (len(self.bias), len(labels))).astype(np.float32)
        self.base = np.zeros(len(labels), np.float32)

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest value of each filter in each window, and where it lies."""
        tops, places = [], []
        for tables in self.tables:
            span = rows.shape[1] - len(tables) + 1
            sums = tables[0][rows[:, :span]]
            for k, table in enumerate(tables[1:], 1):
                sums += table[rows[:, k : k + span]]
            at = sums.argmax(axis=1)
            places.append(at)
            tops.append(np.take_along_axis(sums, at[:, None], 1)[:, 0])
        return np.concatenate(tops, axis=1) + self.bias, places

    def learn(self, rows: np.ndarray, targets: np.ndarray) -> None:
        """Adam on the cross entropy of single windows."""
        network, f = self.network, self.network.filters
        rng = np.random.default_rng(network.seed + 1)
        parameters = [t for tables in self.tables for t in tables]
        parameters += [self.bias, self.out, self.base]
        first = [np.zeros_like(p) for p in parameters]
        second = [np.zeros_like(p) for p in parameters]
        step = 0
        for _ in range(network.epochs):
            order = rng.permutation(len(rows))
            for start in range(0, len(rows), network.batch):
                own = order[start : start + network.batch]
                x, y = rows[own], targets[own]
                top, places = self.pooled(x)
                hidden = np.maximum(top, 0)
                scores = hidden @ self.out + self.base
                scores -= scores.max(axis=1, keepdims=True)
                p = np.exp(scores)
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                p /= len(y)
                back = (p @ self.out.T) * (top > 0)
                gradients = []
                for w, at in enumerate(places):
                    part = back[:, w * f : (w + 1) * f]
                    for k in range(len(self.tables[w])):
                        under = np.take_along_axis(x, at + k, 1)
                        gradient = np.zeros((256, f), np.float32)
                        np.add.at(gradient, (under, np.arange(f)[None, :]), part)
                        gradients.append(gradient)
                gradients += [back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]
                step += 1
                for parameter, gradient, m, v in zip(parameters, gradients, first, second):
                    m += 0.1 * (gradient - m)
                    v += 0.001 * (gradient * gradient - v)
                    size = m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                    parameter -= network.rate * size

    def ready(self) -> "Model":
        """Tables of byte pairs in place of those of single bytes, for fewer look-ups."""
        self.paired = []
        for tables in self.tables:
            steps = []
            for k in range(0, len(tables) - 1, 2):
                pair = tables[k][:, None, :] + tables[k + 1][None, :, :]
                steps.append((k, True, pair.reshape(65536, -1)))
            if len(tables) % 2:
                steps.append((len(tables) - 1, False, tables[-1]))
            self.paired.append((len(tables), steps))
        return self

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        pairs = (rows[:, :-1].astype(np.uint16) << 8) | rows[:, 1:]
        tops = []
        for width, steps in self.paired:
            span = rows.shape[1] - width + 1
            sums = None
            for k, double, table in steps:
                part = table.take((pairs if double else rows)[:, k : k + span], axis=0)
                sums = part if sums is None else np.add(sums, part, out=sums)
            tops.append(sums.max(axis=1))
        hidden = np.maximum(np.concatenate(tops, axis=1) + self.bias, 0)
        scores = hidden @ self.out + self.base
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


#: Hashes of keys are taken modulo this.
HASHES = 1 << 30
#: Labels whose shares fit into any task.
FEW_LABELS = 10_000
#: Windows that are looked up at once; keeps the arrays of a step in the processor's cache.
AT_ONCE = 64


def labelled_sample(
    labelled: DataFrame, network: Network, text: str, lang: str, key: str
) -> list[tuple[str, list[bytes]]]:
    """A bounded number of texts of each label, as windows; of long texts windows at hashed places.

    Rows go by a hash of their key, so the sample is the same in every run and spread over the table.
    """
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("binary").alias("body"),
        F.xxhash64(F.col(key).cast("string")).alias("order"),
    )
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    labels = counts.count()
    most = max(1, min(network.rows_per_language, network.rows // max(1, labels)))
    # Rows below a share of all hashes, a few times as many as wanted, however many rows there are.
    share = F.least(F.lit(HASHES), F.ceil(F.lit(4 * most * HASHES) / F.col("n")))
    shares = counts.select("lang", share.alias("share"))
    size, count = network.window, network.windows_per_row
    long = F.length("body") > size * count

    def at(i: Column) -> Column:
        place = F.pmod(F.xxhash64("order", i), F.length("body") - size + 1).cast("int")
        return F.col("body").substr(place + 1, F.lit(size))

    places = F.transform(F.sequence(F.lit(1), F.lit(count)), at)
    parts = F.when(long, places).otherwise(F.array("body"))
    # Windows, not texts, meet the shares; these are broadcast only where labels are known to be few.
    cut = rows.select("lang", "order", parts.alias("parts"))
    cut = cut.join(F.broadcast(shares) if labels <= FEW_LABELS else shares, "lang")
    bodies = cut.filter(F.pmod("order", F.lit(HASHES)) < F.col("share")).drop("share")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "parts"))
    first = bodies.withColumn("place", place).filter(F.col("place") <= most)
    return [(r["lang"], [bytes(p) for p in r["parts"]]) for r in first.collect()]


def train(
    labelled: DataFrame,
    network: Network = Network(),
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
) -> Model | None:
    """A network fitted on a bounded sample of the labelled rows; None without any."""
    sample = sorted(labelled_sample(labelled, network, text, lang, key))
    labels = sorted({own for own, _ in sample})
    rows, targets = [], []
    numbers = {label: i for i, label in enumerate(labels)}
    for own, parts in sample:
        if len(parts) > 1:
            cut = np.frombuffer(b"".join(parts).lower(), dtype=np.uint8).reshape(-1, network.window)
        else:
            cut = windows_of(parts[0], network.window)
            cut = cut[:-1] if len(cut) > 1 else cut
        rows.append(cut)
        targets.append(np.full(len(cut), numbers[own]))
    if not rows:
        return None
    model = Model(labels, network)
    model.learn(np.concatenate(rows), np.concatenate(targets))
    return model


def predict(
    docs: DataFrame,
    model: Model | None,
    text: str = "text",
    key: str = "doc_id",
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Key, ``lang_pred`` and ``score`` of each row, from all windows of its whole text.

    ``lang_pred`` is a learned label, and ``und`` with score 0 where the text is null or has no
    letter, or nothing was learned. The score is the softmax of the mean log-probabilities. Keys may
    be null or repeated; each row gives one row. ``extra`` columns are handed through.
    """
    kept = docs.select(key, *extra)
    names = [*kept.columns, "lang_pred", "score"]
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]

    def label(body: str) -> tuple[str, float]:
        if model is None or not any(map(str.isalpha, body)):
            return UNDETERMINED, 0.0
        rows = windows_of(body.encode(), model.network.window)
        total = np.zeros(len(model.labels))
        for start in range(0, len(rows), AT_ONCE):
            total += model.log_probabilities(rows[start : start + AT_ONCE]).sum(axis=0)
        total /= len(rows)
        best = int(total.argmax())
        return model.labels[best], float(1 / np.exp(total - total[best]).sum())

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is not None:
            model.ready()
        for batch in batches:
            *others, texts = batch.columns
            found = [label(t.as_py() or "") for t in texts]
            languages = pa.array([x for x, _ in found], pa.string())
            scores = pa.array([x for _, x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*others, languages, scores], names)

    rows = docs.select(key, *extra, F.col(text).cast("string").alias("_text_to_tell"))
    return rows.mapInArrow(convert, ", ".join([*types, "lang_pred string", "score double"]))
