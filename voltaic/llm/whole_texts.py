"""Exact cosine of whole texts: a block-max inverted index of the examples' full TF-IDF vectors.

Vectors hold every word; a word that no example has weighs like the rarest one (it matches nothing
and only lengthens the vector).  Words of a query come in order of their weight: those behind the
point where their joint length falls below a share of ``floor`` can add no more than that length, so
only the lists before it are read, and an example with too small a sum over them is done.  Examples lie in blocks; a block whose largest
possible sum over those lists is too small is skipped.  If the examples left hold more than the next
lists, those are read too.  What is left is worked out exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import stage
from .common import ddl, record_batch, texts, words

#: Examples of a block.
BLOCK = 256
#: Length of the words whose lists are not read, as a share of the floor: at first, and if too many
#: examples are left then.
REST = (0.8, 0.4)
#: Words whose counts a task holds before it passes them on.
HELD = 200_000

_WORD = {"word": "binary", "n": "long"}
_ROW = {"doc_id": "long", "toxic": "int", "ids": "binary", "weights": "binary"}


def own_words(sample: DataFrame) -> frozenset[bytes]:
    """The words of the examples, whose number bounds them."""
    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            for t in texts(b):
                seen.update(words(t))
            if len(seen) > HELD:
                yield record_batch(_WORD, {"word": list(seen), "n": [1] * len(seen)})
                seen = set()
        yield record_batch(_WORD, {"word": list(seen), "n": [1] * len(seen)})

    found = sample.select(F.col("text").cast("string").alias("text")).mapInArrow(run, ddl(_WORD)).select("word").distinct()
    return frozenset(found.toArrow().column("word").to_pylist())


def frequencies(docs: DataFrame, known: frozenset[bytes], more) -> dict[bytes, int]:
    """Documents of ``docs`` that hold each word of ``known``, and each key that ``more()`` (called in
    every task) gives for the set of a document's words; from one pass over all whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        wanted, keys, seen = sent.value, more(), Counter()
        for b in batches:
            for t in texts(b):
                own = set(words(t))
                seen.update(own & wanted)
                seen.update(keys(own))
        yield record_batch(_WORD, {"word": list(seen), "n": list(seen.values())})

    found = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, ddl(_WORD))
             .groupBy("word").agg(F.sum("n").alias("n")).toArrow())
    return dict(zip(found.column("word").to_pylist(), found.column("n").to_pylist()))


class Weights:
    """Inverse document frequencies of the examples' words."""

    def __init__(self, found: dict[bytes, int], total: int):
        self.ids = {w: k for k, w in enumerate(sorted(found))}
        n = np.fromiter((found[w] for w in self.ids), np.int64, len(found))
        self.idf = np.log(1 + total / (1 + n))
        self.rarest = math.log(1 + total / 2)

    def vector(self, counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers, ascending, and their weights in the text's unit vector."""
        ids = np.fromiter(map(self.ids.get, counts, repeat(-1)), np.int64, len(counts))
        weights = 1 + np.log(np.fromiter(counts.values(), float, len(counts)))
        known = ids >= 0
        rest, ids = weights[~known], ids[known]
        weights = weights[known] * self.idf[ids]
        length = math.sqrt(float(weights @ weights) + float(rest @ rest) * self.rarest ** 2) or 1.0
        order = np.argsort(ids)
        return ids[order], weights[order] / length


def vectors(sample: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, toxic, ids and weights (32-bit numbers as bytes) of every example."""
    sent = sample.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        own = sent.value
        for b in batches:
            cols = {"doc_id": b.column("doc_id").to_pylist(), "toxic": b.column("toxic").to_pylist(), "ids": [], "weights": []}
            for t in texts(b):
                ids, w = own.vector(counted(t))
                cols["ids"].append(ids.astype(np.int32).tobytes())
                cols["weights"].append(w.astype(np.float32).tobytes())
            yield record_batch(_ROW, cols)

    return stage(sample.select("doc_id", "toxic", "text").mapInArrow(run, ddl(_ROW)), "toxicity-whole")


def counted(text: bytes | None) -> dict[bytes, int]:
    return Counter(words(text))


class WholeTexts:
    """The examples' vectors as posting lists over words, and the largest weight of a list per block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_words: int, block: int = BLOCK):
        # Examples that share their heaviest word are neighbours, which makes for low block maxima.
        lead = [int(i[w.argmax()]) if len(i) else -1 for i, w in vectors]
        order = sorted(range(len(vectors)), key=lambda k: (lead[k], k))
        self.place = np.argsort(order)  # example -> where it lies
        self.example = np.array(order, np.int64)
        self.block, self.n = block, len(vectors)
        sizes = np.array([len(vectors[k][0]) for k in order], np.int64)
        ids = np.concatenate([vectors[k][0] for k in order]) if len(order) else np.zeros(0, np.int64)
        w = np.concatenate([vectors[k][1] for k in order]) if len(order) else np.zeros(0)
        # The vectors themselves, for the exact sums of what is left.
        self.from_, self.words, self.weights = np.concatenate(([0], np.cumsum(sizes))), ids.astype(np.int32), w.astype(np.float32)
        by = np.argsort(ids, kind="stable")
        # Small types, as every worker holds a copy; weights are rounded to 24 bits.
        self.at = np.repeat(np.arange(self.n, dtype=np.uint16 if self.n < 1 << 16 else np.int32), sizes)[by]
        self.w = w[by].astype(np.float32)
        ids = ids[by]
        self.first = np.searchsorted(ids, np.arange(n_words + 1))
        blocks = -(-self.n // block) or 1
        key = ids * blocks + self.at.astype(np.int64) // block
        heads = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.zeros(0, np.int64)
        self.most = np.maximum.reduceat(self.w, heads) if len(heads) else np.zeros(0)
        self.most_block = (key[heads] % blocks).astype(np.uint16 if blocks < 1 << 16 else np.int32)
        self.most_first = np.searchsorted(key[heads] // blocks, np.arange(n_words + 1))
        self.blocks = blocks

    @staticmethod
    def _lists(first: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the lists of some words one after the other, and each list's length."""
        lo, size = first[ids], first[ids + 1] - first[ids]
        ends = np.cumsum(size)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - size), size), size

    def near(self, ids: np.ndarray, weights: np.ndarray, floor: float, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Examples whose cosine with the vector is ``floor`` or more, and the cosines."""
        none = np.zeros(0, np.int64), np.zeros(0)
        if not self.n or not len(ids):
            return none
        order = np.argsort(-weights, kind="stable")
        ids, weights = ids[order], weights[order]
        tails = np.sqrt(np.maximum(np.append(np.cumsum(weights[::-1] ** 2)[::-1], 0.0), 0.0))
        slack = 1e-6  # what rounded weights may be off
        if tails[0] < floor - slack:
            return none
        # Lists are read until the rest is short against the floor, so that few examples are left.
        heads = [int(np.argmax(tails < share * floor)) for share in REST]
        places, size = self._lists(self.most_first, ids[:heads[0]])
        bound = np.bincount(self.most_block[places], np.repeat(weights[:heads[0]], size) * self.most[places], self.blocks)
        live = bound + tails[heads[0]] >= floor - slack
        if not live.any():
            return none
        live, score = np.repeat(live, self.block)[:self.n], np.zeros(self.n)
        for start, head, after in zip([0, *heads], heads, [*heads[1:], heads[-1]]):
            places, size = self._lists(self.first, ids[start:head])
            own = np.repeat(weights[start:head], size)
            if not live.all():
                kept = live[self.at[places]]
                places, own = places[kept], own[kept]
            score += np.bincount(self.at[places], own * self.w[places], self.n)
            live = score + tails[head] >= floor - slack
            found = np.flatnonzero(live)
            more = ids[head:after]
            if (self.from_[found + 1] - self.from_[found]).sum() <= (self.first[more + 1] - self.first[more]).sum():
                break
        sims = np.zeros(len(found))
        if len(found):
            order = np.argsort(ids)
            ids, weights = ids[order], weights[order]
            places, size = self._lists(self.from_, found)  # the candidates' own words
            k = np.minimum(np.searchsorted(ids, self.words[places]), len(ids) - 1)
            same = ids[k] == self.words[places]
            sims = np.bincount(np.repeat(np.arange(len(found)), size)[same], weights[k[same]] * self.weights[places[same]], len(found))
        kept = sims >= floor - slack
        found, sims = self.example[found[kept]], np.minimum(np.round(sims[kept], 6), 1.0)
        if without is not None:
            kept = found != without
            found, sims = found[kept], sims[kept]
        return found, sims
