"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page's leaf blocks are a chain of two labels, main and rest. Features are the tags and class words
of a block's ancestors and simple traits of its text, never its words, so the model is the same for
all languages. It is trained on labelled pages by the gradient of the chain's log-likelihood, and
pages are decoded by Viterbi.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topictally.llm.html_blocks import Block, Step, leaf_blocks
from topictally.llm.labelled_pages import LABEL, labelled_pages

REST, MAIN = 0, 1


def own_features(block: Block) -> list[str]:
    """What the model sees of a block but for what its ancestors are."""
    text = block.text
    found = ["always", f"tag {block.step.name if block.step else 'none'}"]
    length = len(text)
    found.append(f"length {min(length.bit_length(), 9)}")
    share = 10 * block.linked // max(length, 1)
    found.append("links " + ("none" if not block.linked else "some" if share < 5 else "most"))
    if block.controls:
        found.append("controls")
    if text[-1] in ".!?:;…。":
        found.append("sentence")
    if "©" in text or "(c)" in text[:40].lower():
        found.append("copyright")
    return found


def features(block: Block) -> list[str]:
    """What the model sees of a block, without its neighbours."""
    found = own_features(block)
    step = block.step
    while step:
        found += step.own
        step = step.parent
    return found


class Chain:
    """Weights of the features for label main, and of the steps from label to label."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray, first: np.ndarray):
        self.weights, self.steps, self.first = weights, steps, first

    def scores(self, blocks: list[Block]) -> np.ndarray:
        """The blocks' weights for label main; what ancestors add is summed once for each of them."""
        get = self.weights.get
        sums: dict[int, float] = {}

        def above(step: Step | None) -> float:
            new = []
            while step and id(step) not in sums:
                new.append(step)
                step = step.parent
            total = sums[id(step)] if step else 0.0
            for step in reversed(new):
                total += sum(get(f, 0.0) for f in step.own)
                sums[id(step)] = total
            return total

        return np.array([above(b.step) + sum(get(f, 0.0) for f in own_features(b)) for b in blocks])

    def viterbi(self, blocks: list[Block]) -> list[int]:
        """The most probable labels of a page's blocks."""
        if not blocks:
            return []
        return best_path(self.scores(blocks).tolist(), self.steps.tolist(), self.first.tolist())


def best_path(scores: list[float], steps: list[list[float]], first: list[float]) -> list[int]:
    rest, main = first[REST], first[MAIN] + scores[0]
    back = []
    for score in scores[1:]:
        to_rest = (rest + steps[REST][REST], main + steps[MAIN][REST])
        to_main = (rest + steps[REST][MAIN], main + steps[MAIN][MAIN])
        back.append((to_rest[1] > to_rest[0], to_main[1] >= to_main[0]))
        rest, main = max(to_rest), max(to_main) + score
    label = int(main > rest)
    path = [label]
    for choice in reversed(back):
        label = int(choice[label])
        path.append(label)
    return path[::-1]


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _expected(scores: np.ndarray, steps: np.ndarray, first: np.ndarray):
    """Marginals of label main, expected steps, and those of the first label (forward-backward)."""
    n = len(scores)
    emission = np.stack([np.zeros(n), scores], axis=1)
    forward, backward = np.empty((n, 2)), np.zeros((n, 2))
    forward[0] = first + emission[0]
    for t in range(1, n):
        forward[t] = emission[t] + _log_sum(forward[t - 1][:, None] + steps, 0)
    for t in range(n - 2, -1, -1):
        backward[t] = _log_sum(steps + (emission[t + 1] + backward[t + 1])[None, :], 1)
    total = _log_sum(forward[-1], 0)
    marginal = np.exp(forward + backward - total)
    moved = np.zeros((2, 2))
    for t in range(1, n):
        joint = forward[t - 1][:, None] + steps + (emission[t] + backward[t])[None, :]
        moved += np.exp(joint - total)
    return marginal[:, MAIN], moved, marginal[0]


def train(
    pages: Iterable[tuple[list[Block], list[int]]],
    epochs: int = 12,
    rate: float = 0.2,
    shrink: float = 0.001,
) -> Chain:
    """Fit the chain to labelled pages by stochastic gradient ascent (AdaGrad) of the likelihood."""
    examples = []
    number: dict[str, int] = {}
    for blocks, labels in pages:
        rows = [[number.setdefault(f, len(number)) for f in features(b)] for b in blocks]
        if rows:
            examples.append((rows, np.array(labels)))
    weights, steps, first = np.zeros(len(number)), np.zeros((2, 2)), np.zeros(2)
    seen = [np.full_like(x, 1e-6) for x in (weights, steps, first)]
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            rows, labels = examples[i]
            counts = np.array([len(r) for r in rows])
            flat = np.concatenate([np.array(r) for r in rows])
            owner = np.repeat(np.arange(len(rows)), counts)
            scores = np.bincount(owner, weights[flat], minlength=len(rows))
            marginal, moved, begun = _expected(scores, steps, first)
            of_weights = np.zeros(len(weights))
            np.add.at(of_weights, flat, (labels - marginal)[owner])
            of_weights -= shrink * weights
            of_steps = -moved
            np.add.at(of_steps, (labels[:-1], labels[1:]), 1)
            of_first = -begun
            of_first[labels[0]] += 1
            for x, gradient, total in zip(
                (weights, steps, first), (of_weights, of_steps, of_first), seen
            ):
                total += gradient * gradient
                x += rate * gradient / np.sqrt(total)
    return Chain({f: float(weights[i]) for f, i in number.items()}, steps, first)


def train_on_labelled_pages(pages: Iterable[str] | None = None) -> Chain:
    """A chain fitted to pages whose main elements carry the label."""
    return train(map(labelled_blocks, labelled_pages() if pages is None else pages))


def labelled_blocks(page: str) -> tuple[list[Block], list[int]]:
    """A labelled page's blocks without their label, and whether each is main.

    An element named by the label itself is not there for the model, only its text is.
    """
    blocks, labels = [], []
    for block in leaf_blocks(page):
        steps = []
        step = block.step
        while step:
            steps.append(step)
            step = step.parent
        labels.append(int(any(LABEL in f for step in steps for f in step.own)))
        plain = None
        for step in reversed(steps):
            if step.name != LABEL:
                plain = Step(plain, step.name, tuple(f for f in step.own if LABEL not in f))
        blocks.append(block._replace(step=plain))
    return blocks, labels


def main_text(html: str, chain: Chain) -> str:
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, label in zip(blocks, chain.viterbi(blocks)) if label == MAIN)


def extract(
    pages: DataFrame,
    chain: Chain | None = None,
    html: str = "html",
    keys: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """The key columns and the main ``text`` of each page, blocks joined by line ends.

    A null or empty page has an empty text. Keys may be null or repeated; each row gives one row.
    Without a ``chain`` one is trained on the labelled pages. Other columns are not read.
    """
    chain = chain or train_on_labelled_pages()
    names = [*keys, "text"]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, bodies = batch.columns
            texts = [main_text(body.as_py() or "", chain) for body in bodies]
            yield pa.RecordBatch.from_arrays([*others, pa.array(texts, pa.string())], names)

    types = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keys]
    rows = pages.select(*keys, F.col(html).cast("string").alias("_page_to_read"))
    return rows.mapInArrow(convert, ", ".join([*types, "text string"]))
