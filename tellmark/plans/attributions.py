"""Which words a score rests on, for any model that can score texts: hierarchical masking.

A text's words are the leaves of a binary tree of adjacent words. A node is worth what the score
gains when its words are put into a text in which the words outside are partly masked; halving a node
shares its worth among its halves as Owen values do, over both orders in which they can be put in.
Where the halves do not interact, which two scores tell, one order is as good as two and only that
one is followed, so a model that adds up over words is explained exactly by about two scores a word.
Whatever is not split further is shared evenly among its words, so all shares always add up to the
score of the text less the score of the masked text.

Texts are masked and scored in the tasks, many variants of many texts in one batch of the plugged-in
model. Nothing is shuffled.
"""
from __future__ import annotations

import itertools
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tellmark import lexicon as L

cloudpickle.register_pickle_by_value(sys.modules[__name__])
WORD = re.compile(L.WORD)
#: Scores spent on one text, besides those of the whole and the masked text.
EVALUATIONS = 512
#: Characters of masked texts that are scored at once, and texts that are explained at once.
BATCH_CHARS = 1 << 22
TEXTS = 64
#: Two gains closer than this are equal.
EQUAL = 1e-12
SCHEMA = "review_id bigint, start int, end int, text string, score double"


@dataclass
class Node:
    """Adjacent words low..high, what else is unmasked (ranges of words), the score without and with
    them, and the weight of this order among all."""

    low: int
    high: int
    shown: tuple[tuple[int, int], ...]
    without: float
    together: float
    weight: float

    def gain(self) -> float:
        return (self.together - self.without) * self.weight


@dataclass
class Masked:
    """One text, the places of its words, the text with all of them masked, where each word's mask lies
    in that, and the nodes still to be split."""

    review_id: int
    text: str
    mask: str
    words: list[re.Match] = field(init=False)
    places: list[tuple[int, int]] = field(init=False)
    blank: str = field(init=False)
    blank_starts: list[int] = field(init=False)
    shares: np.ndarray = field(init=False)
    open: list[Node] = field(default_factory=list)
    left: int = EVALUATIONS

    def __post_init__(self) -> None:
        self.words = list(WORD.finditer(self.text))
        self.places = [w.span() for w in self.words]
        self.shares = np.zeros(len(self.places))
        gaps = WORD.split(self.text)
        self.blank = self.mask.join(gaps)
        self.blank_starts = [size - len(self.mask) for size in itertools.accumulate(len(gap) + len(self.mask) for gap in gaps[:-1])]

    def shown(self, ranges: tuple[tuple[int, int], ...]) -> str:
        """The text with all words masked but those of some ranges: cut in turn from the masked and
        from the whole text."""
        parts, at, done = [], 0, 0
        for low, high in sorted(ranges):
            low, done = max(low, done), max(high, done)
            if low >= high:
                continue
            parts += [self.blank[at : self.blank_starts[low]], self.text[self.places[low][0] : self.places[high - 1][1]]]
            at = self.blank_starts[high - 1] + len(self.mask)
        return "".join([*parts, self.blank[at:]])

    def settle(self, node: Node) -> None:
        """Share a node's worth evenly among its words, if it cannot be split."""
        self.shares[node.low : node.high] += node.gain() / (node.high - node.low)

    def to_split(self) -> list[Node]:
        """The nodes worth most that the remaining scores suffice for; single words are settled."""
        for node in self.open:
            if node.high - node.low == 1:
                self.settle(node)
        self.open = sorted((n for n in self.open if n.high - n.low > 1), key=lambda n: (-abs(n.gain()), n.low))
        chosen, self.open = self.open[: self.left // 2], self.open[self.left // 2 :]
        self.left -= 2 * len(chosen)
        if not chosen:
            for node in self.open:
                self.settle(node)
            self.open = []
        return chosen

    def split(self, node: Node, one: float, two: float) -> None:
        """Put the halves of a node in its place; one and two are the scores with one half each."""
        middle = (node.low + node.high) // 2
        first, second = (node.low, middle), (middle, node.high)
        if abs((one - node.without) - (node.together - two)) <= EQUAL:
            self.open += [Node(*first, node.shown, node.without, one, node.weight), Node(*second, (*node.shown, first), one, node.together, node.weight)]
            return
        half = node.weight / 2
        self.open += [
            Node(*first, node.shown, node.without, one, half), Node(*first, (*node.shown, second), two, node.together, half),
            Node(*second, node.shown, node.without, two, half), Node(*second, (*node.shown, first), one, node.together, half)]


def shares(texts: list[tuple[int, str]], score: Callable[[list[str]], np.ndarray], mask: str = "", evaluations: int = EVALUATIONS) -> list[Masked]:
    """Explain some texts together; `score` takes many texts at a time."""
    rows = [Masked(i, text, mask, left=evaluations) for i, text in texts]
    ends = score([x for r in rows for x in (r.shown(()), r.text)])
    for r, without, together in zip(rows, ends[::2], ends[1::2]):
        if len(r.words):
            r.open = [Node(0, len(r.words), (), float(without), float(together), 1.0)]
    while chosen := [(r, n) for r in rows for n in r.to_split()]:
        variants = []
        for r, n in chosen:
            middle = (n.low + n.high) // 2
            variants += [r.shown((*n.shown, (n.low, middle))), r.shown((*n.shown, (middle, n.high)))]
        found = score(variants)
        for (r, n), one, two in zip(chosen, found[::2], found[1::2]):
            r.split(n, float(one), float(two))
    return rows


def _batched(predict: Callable[[pd.DataFrame], pd.DataFrame], output: str) -> Callable[[list[str]], np.ndarray]:
    """Score texts by a plugged-in model, BATCH_CHARS at a time."""

    def score(texts: list[str]) -> np.ndarray:
        found, held, size = [], [], 0
        for text in [*texts, None]:
            if held and (text is None or size + len(text) > BATCH_CHARS):
                found.append(predict(pd.DataFrame({"review_id": np.arange(len(held)), "text": held}))[output].to_numpy(float))
                held, size = [], 0
            if text is not None:
                held.append(text)
                size += len(text)
        return np.concatenate(found) if found else np.empty(0)

    return score


def attributions(
    df: DataFrame, loader: Callable, output: str = "prob", prob: str = "prob", least: float = L.HIGHLIGHT_FROM, mask: str = "", evaluations: int = EVALUATIONS,
) -> DataFrame:
    """(review_id, start, end, text, score): the share of every word in the plugged-in score.

    `loader` is that of `score_with_model` and `output` the column it gives, for batches with
    review_id and text; it should treat texts one by one. Only reviews with `prob` >= `least` are
    explained. `mask` takes a masked word's place. A word's share is 0 where it changes nothing; null
    texts and texts without words give no row. With at least 2 * words ** 2 evaluations the shares are
    the tree's Owen values whatever the model; with fewer, the nodes worth most are split first.
    """
    wanted = df.filter(F.col(prob) >= least).filter("text is not null").select(F.col("review_id").cast("bigint"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = _batched(loader(), output)
        for batch in batches:
            for i in range(0, len(batch), TEXTS):
                part = batch.iloc[i : i + TEXTS]
                rows = shares(list(zip(part.review_id, part.text)), score, mask, evaluations)
                sizes = [len(r.words) for r in rows]
                if not sum(sizes):  # an empty column of strings is no Arrow array
                    continue
                places = np.array([p for r in rows for p in r.places], np.int64).reshape(-1, 2)
                yield pd.DataFrame({
                    "review_id": np.repeat(part.review_id.to_numpy(), sizes), "start": places[:, 0], "end": places[:, 1],
                    "text": [w[0] for r in rows for w in r.words], "score": np.concatenate([r.shares for r in rows])})

    return wanted.mapInPandas(run, SCHEMA)
