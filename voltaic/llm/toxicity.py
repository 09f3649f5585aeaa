"""Toxicity by the nearest labelled examples in TF-IDF space.

Fit (on a bounded, documented sample of labelled rows):

* one example is kept of every group of near copies (several min-hashes of word triples agree), so
  a text copied many times does not make its words look telling;
* telling terms are words and word beginnings that toxic examples hold significantly more
  often (likelihood ratio), a bounded number;
* document frequencies of the telling terms and of all words of the examples are counted over
  all documents;
* examples with equal vectors of telling terms become one prototype that carries the label counts;
* scores are calibrated by isotonic regression on leave-one-out votes.

Scoring compares a document with the examples in two ways, both by exact cosine over block-max
inverted indexes:

* whole texts (:mod:`voltaic.llm.whole_texts`), all words; what differs in telling terms counts for
  less: the similarity is the cosine of the whole vectors times that of the telling terms;
* telling terms alone, among the prototypes, so that a few of them tell in a long text.

Both give distance-weighted votes.  The closer the nearest whole text, the more its side decides:
alone at a copy, not at all below NEAR.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import stage
from . import whole_texts
from .common import ddl, record_batch, texts, words

#: Labelled rows that the model is fitted on, at most.
MAX_EXAMPLES = 20_000
#: Terms of the vocabulary, at most, and candidates for it.
MAX_TERMS, MAX_CANDIDATES = 1_024, 20_000
#: A term needs this many toxic examples, and a likelihood ratio that chance gives less than
#: once in so many vocabularies.
MIN_SUPPORT, VOCABULARIES = 4, 20
#: Lengths of word beginnings, in bytes.
BEGINNINGS = (4, 5, 6, 7)
NEIGHBOURS = 15
BLOCK = 64
#: Prototypes whose leave-one-out votes calibrate the scores, at most.
MAX_CALIBRATION = 1_500
THRESHOLD = 0.3
#: Least similarity of whole texts that vote.
NEAR = 0.6
#: Examples whose whole texts are compared, at most: toxic ones first, up to half, then others.
MAX_WHOLE = 4_000
#: Min-hashes that near copies among the examples share.
HASHES = 3

_VECTOR = {"doc_id": "long", "terms": "array<int>", "counts": "array<int>"}
_SCORE = {"doc_id": "long", "score": "double", "evidence": "array<long>", "similarity": "array<double>"}


def held_out(doc_id="doc_id"):
    """Rows whose labels are never learned: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _terms(counts: dict[bytes, int]) -> Counter:
    """Words and word beginnings (marked by a *) with their counts."""
    out = Counter(counts)
    for w, n in counts.items():
        for k in BEGINNINGS:
            if len(w) > k:
                out[w[:k] + b"*"] += n
    return out


def _heads(ids: dict[bytes, int]) -> frozenset[bytes]:
    """What words with a term of the vocabulary begin with."""
    return frozenset(k.rstrip(b"*")[:BEGINNINGS[0]] for k in ids)


def _picked(counts: dict[bytes, int], ids: dict[bytes, int], heads: frozenset[bytes] | None = None) -> dict[int, int]:
    """Counts of the vocabulary's terms, by term number.

    heads: :func:`_heads` of the vocabulary, where it is known already."""
    heads, first = _heads(ids) if heads is None else heads, BEGINNINGS[0]
    out: dict[int, int] = {}
    for w in [w for w in counts if w[:first] in heads]:
        n, k = counts[w], ids.get(w)
        if k is not None:
            out[k] = out.get(k, 0) + n
        for size in BEGINNINGS:
            if len(w) > size:
                k = ids.get(w[:size] + b"*")
                if k is not None:
                    out[k] = out.get(k, 0) + n
    return out


def _signature(ws: list[bytes]) -> int:
    triples = {b" ".join(ws[k:k + 3]) for k in range(max(1, len(ws) - 2))}
    least = [min(xxhash.xxh64_intdigest(t, 5 + seed) for t in triples) for seed in range(HASHES)]
    return xxhash.xxh64_intdigest(repr(least)) - 2**63


def _ratio(a, b, pos: int, neg: int):
    """Log likelihood ratio of a term in a of pos and b of neg examples; 0 unless toxic ones hold it more."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    share = (a + b) / (pos + neg)
    out = np.zeros_like(a)
    for seen, total in ((a, pos), (b, neg)):
        for x, e in ((seen, total * share), (total - seen, total * (1 - share))):
            out += np.where(x > 0, x * np.log(np.where(x > 0, x, 1) / np.where(e > 0, e, 1)), 0)
    return np.where(a / max(pos, 1) > b / max(neg, 1), 2 * out, 0)


def examples(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """doc_id, toxic, text of at most ``max_examples`` labelled documents outside the held-out
    fold, one of each group of near copies."""
    chosen = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples))
    found = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
             .join(F.broadcast(chosen), "doc_id"))  # max_examples rows of 12 bytes at most
    spec = {"doc_id": "long", "toxic": "int", "text": "string", "signature": "long"}

    def run(batches):
        for b in batches:
            yield record_batch(spec, {"doc_id": b.column("doc_id").to_pylist(), "toxic": b.column("toxic").to_pylist(),
                                      "text": b.column("text").to_pylist(), "signature": [_signature(words(t)) for t in texts(b)]})

    signed = stage(found.mapInArrow(run, ddl(spec)), "toxicity-examples")
    first = signed.groupBy("signature", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return signed.join(F.broadcast(first.select("doc_id", "toxic")), ["doc_id", "toxic"]).dropDuplicates(["doc_id"]) \
        .select("doc_id", "toxic", "text")


def vocabulary(sample: DataFrame) -> list[str]:
    """Terms (bytes as Latin-1 text) that tell toxic examples from others, best first."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    spec = {"term": "string", "n": "long"}

    def counted(wanted=None):
        def run(batches):
            seen: Counter = Counter()
            for b in batches:
                for t in texts(b):
                    got = _terms(dict.fromkeys(words(t), 1)).keys()
                    seen.update(got if wanted is None else got & wanted.value)
                if len(seen) > 200_000:
                    yield record_batch(spec, {"term": [k.decode("latin-1") for k in seen], "n": list(seen.values())})
                    seen = Counter()
            yield record_batch(spec, {"term": [k.decode("latin-1") for k in seen], "n": list(seen.values())})
        return run

    count = lambda toxic, f: (sample.where(F.col("toxic") == toxic).select("text").mapInArrow(f, ddl(spec))
                              .groupBy("term").agg(F.sum("n").alias("n")))
    cand = {r["term"]: r["n"] for r in count(1, counted()).where(F.col("n") >= MIN_SUPPORT)
            .orderBy(F.desc("n"), "term").limit(MAX_CANDIDATES).collect()}
    if not cand or not neg:
        return []
    wanted = sample.sparkSession.sparkContext.broadcast({k.encode("latin-1") for k in cand})
    other = {r["term"]: r["n"] for r in count(0, counted(wanted)).collect()}
    names = list(cand)
    ratio = _ratio([cand[k] for k in names], [other.get(k, 0) for k in names], pos, neg)
    best = sorted(((-r, k) for r, k in zip(ratio.tolist(), names) if r >= 2 * math.log(VOCABULARIES * len(cand))))
    return [k for _, k in best[:MAX_TERMS]]


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id and the sparse term counts of every whole text."""
    ids = docs.sparkSession.sparkContext.broadcast({k.encode("latin-1"): n for n, k in enumerate(terms)})

    def run(batches):
        known = ids.value
        heads = _heads(known)
        for b in batches:
            cols = {"doc_id": b.column("doc_id").to_pylist(), "terms": [], "counts": []}
            for t in texts(b):
                got = _picked(Counter(words(t)), known, heads)
                cols["terms"].append(sorted(got))
                cols["counts"].append([got[k] for k in sorted(got)])
            yield record_batch(_VECTOR, cols)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ddl(_VECTOR))


class BlockMaxIndex:
    """Prototypes in blocks: per term, the blocks that hold it, their maximum weight and postings."""

    def __init__(self, prototypes: list[tuple], idf: np.ndarray, block: int = BLOCK):
        """prototypes: (terms, counts, toxic examples, other examples, a doc_id)."""
        self.idf, self.block = idf, block
        self.protos = sorted(prototypes, key=lambda p: (p[0], p[1]))
        self.votes = np.array([p[2:4] for p in self.protos], float).reshape(-1, 2)
        self.ids = [p[4] for p in self.protos]
        postings: dict[int, dict[int, list]] = {}
        self.zero = None
        for k, (terms, counts, *_) in enumerate(self.protos):
            if not terms:
                self.zero = k
            for t, w in zip(*self.weights(terms, counts)):
                postings.setdefault(t, {}).setdefault(k // block, []).append((k % block, w))
        self.lists = {t: {b: (np.array([i for i, _ in p]), np.array([w for _, w in p])) for b, p in blocks.items()}
                      for t, blocks in postings.items()}
        self.most = {t: (np.array(list(blocks)), np.array([w.max() for _, w in blocks.values()]))
                     for t, blocks in self.lists.items()}
        self.n_blocks = -(-len(self.protos) // block)

    def weights(self, terms, counts) -> tuple[list[int], list[float]]:
        w = [(1 + math.log(c)) * float(self.idf[t]) for t, c in zip(terms, counts)]
        norm = math.sqrt(sum(x * x for x in w)) or 1.0
        return list(terms), [x / norm for x in w]

    def nearest(self, terms, counts, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and numbers of the k nearest prototypes and all that tie with the last.

        A text without terms is at similarity 1 to the prototype without terms and 0 to others.
        """
        if not terms:
            return (np.array([]), np.array([], int)) if self.zero is None else (np.array([1.0]), np.array([self.zero]))
        query = [(t, w) for t, w in zip(*self.weights(terms, counts)) if t in self.lists]
        bound = np.zeros(self.n_blocks)
        for t, w in query:
            blocks, most = self.most[t]
            bound[blocks] += w * most
        sims, found, kth = [], [], 0.0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or bound[b] < kth - 1e-12:
                break
            score = np.zeros(self.block)
            for t, w in query:
                own = self.lists[t].get(int(b))
                if own is not None:
                    score[own[0]] += w * own[1]
            hit = np.flatnonzero((score > 0) & (score >= kth - 1e-12))
            if without is not None:
                hit = hit[hit + b * self.block != without]
            sims.extend(score[hit].tolist())
            found.extend((hit + b * self.block).tolist())
            if len(sims) >= k:
                kth = np.partition(np.array(sims), -k)[-k]
        s, f = np.round(np.array(sims), 12), np.array(found, int)
        order = np.lexsort((f, -s))
        s, f = s[order], f[order]
        keep = s >= s[min(k, len(s)) - 1] if len(s) else slice(0)
        return s[keep], f[keep]

    def vote(self, terms, counts, k: int = NEIGHBOURS, leave: tuple[int, int] | None = None):
        """Share of toxic examples among the nearest, weighted by 1 / (distance + 0.05).

        leave: (prototype, label) of an example that must not vote for itself.
        """
        alone = leave is not None and self.votes[leave[0]].sum() <= 1
        sims, near = self.nearest(terms, counts, k, leave[0] if alone else None)
        if not len(near):
            return 0.0, sims, near
        votes = self.votes[near].copy()
        if leave is not None and not alone:
            votes[near == leave[0], 1 - leave[1]] -= 1
        w = 1 / (1 - sims + 0.05)
        total = float((w[:, None] * votes).sum())
        return (float((w * votes[:, 0]).sum()) / total if total > 0 else 0.0), sims, near


def isotonic(x: list[float], y: list[float], weight: list[float]) -> tuple[list[float], list[float]]:
    """Pool adjacent violators: knots (x, smoothed share of y) that never fall."""
    blocks: list[list[float]] = []  # weighted x, positives, weight
    merged: dict[float, list[float]] = {}
    for a, b, w in zip(x, y, weight):
        m = merged.setdefault(a, [0.0, 0.0])
        m[0] += b * w
        m[1] += w
    for a in sorted(merged):
        blocks.append([a * merged[a][1], *merged[a]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    ys = [(p + 0.05) / (w + 0.1) for _, p, w in blocks]
    return [a / w for a, _, w in blocks], np.maximum.accumulate(ys).tolist() if ys else []


class Model:
    def __init__(self, index: BlockMaxIndex, knots: tuple[list[float], list[float]], prior: float, terms: list[str],
                 weights: whole_texts.Weights, whole: whole_texts.WholeTexts, labels: np.ndarray, ids: list, own: list[dict[int, float]],
                 counts: np.ndarray):
        """own: unit vectors of telling terms of the examples whose whole texts are compared; counts:
        how many examples each of them stands for."""
        self.index, self.knots, self.prior, self.terms = index, knots, prior, terms
        self.weights, self.whole, self.labels, self.ids, self.own, self.counts = weights, whole, labels, ids, own, counts

    def unit(self, terms, counts) -> dict[int, float]:
        return dict(zip(*self.index.weights(terms, counts)))

    def whole_vote(self, vector, telling: dict[int, float], without: int | None = None):
        """How much whole texts decide (0 to 1), their vote, similarities and examples, nearest first."""
        found, sims = self.whole.near(*vector, NEAR, without)
        same = [sum(w * self.own[k].get(t, 0.0) for t, w in telling.items()) if telling and self.own[k] else float(not telling and not self.own[k])
                for k in found.tolist()]
        sims = np.round(sims * np.array(same, float), 12)
        kept = sims >= NEAR
        found, sims = found[kept], sims[kept]
        if not len(found):
            return 0.0, 0.0, sims, found
        order = np.lexsort((found, -sims))
        found, sims = found[order], sims[order]
        w = self.counts[found] / (1 - sims + 0.05)
        return ((float(sims[0]) - NEAR) / (1 - NEAR)) ** 2, float((w * self.labels[found]).sum() / w.sum()), sims, found

    def votes(self, vector, terms, counts, leave: tuple[int, int, int] | None = None, telling=None):
        """The joint vote, and similarities and doc_ids of its evidence.

        leave: (example, prototype, label) that must not vote for itself.  telling: the answer of
        the prototypes, where it is known already."""
        p, sims, near = telling or self.index.vote(terms, counts, leave=leave[1:] if leave else None)
        share, q, wsims, found = self.whole_vote(vector, self.unit(terms, counts), leave[0] if leave else None)
        ids = [self.ids[k] for k in found.tolist()] + [self.index.ids[k] for k in near]
        return (1 - share) * p + share * q, wsims.tolist() + list(sims), ids

    def score(self, words_counted: dict[bytes, int], terms, counts, telling=None) -> tuple[float, list[int], list[float]]:
        if not self.index.protos:
            return self.prior, [], []
        vote, sims, ids = self.votes(self.weights.vector(words_counted), terms, counts, None, telling)
        p = float(np.interp(vote, *self.knots)) if self.knots[0] else vote
        shown: dict[int, float] = {}
        for i, x in zip(ids, sims):
            shown.setdefault(i, float(x))
        return min(1.0, max(0.0, p)), list(shown)[:NEIGHBOURS], list(shown.values())[:NEIGHBOURS]


class Scorer:
    """Scores texts; the prototypes' answer to a vector of telling terms is kept for the next text."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.numbers = {k.encode("latin-1"): n for n, k in enumerate(model.terms)}
        self.heads = _heads(self.numbers)

    def __call__(self, text: bytes | None) -> tuple[float, list[int], list[float]]:
        counts = whole_texts.counted(text)
        got = _picked(counts, self.numbers, self.heads)
        terms = tuple(sorted(got))
        key = terms, tuple(got[k] for k in terms)
        if self.model.index.protos and key not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[key] = self.model.index.vote(*key)
        return self.model.score(counts, *key, self.known.get(key))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_whole: int = MAX_WHOLE) -> Model:
    """The model; the driver sees max_examples vectors of telling terms, max_whole of whole texts
    and the counts of their words."""
    sample = stage(examples(docs, labels, max_examples), "toxicity-sample")
    terms = vocabulary(sample)
    numbers = {k.encode("latin-1"): n for n, k in enumerate(terms)}
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def telling():
        ids = sent.value
        heads = _heads(ids)
        return lambda own: [b"\0", *(b"\0%d" % k for k in _picked(dict.fromkeys(own, 1), ids, heads))]  # no word has a zero byte

    # Whole texts of a bounded number of examples: toxic ones first, which are few, then others.
    every = {r["doc_id"]: r["toxic"] for r in sample.select("doc_id", "toxic").toLocalIterator()}
    chosen: list[int] = []
    for label, most in ((1, max_whole // 2), (0, max_whole)):
        own = sorted((i for i, t in every.items() if t == label), key=lambda i: xxhash.xxh64_intdigest(str(i), 7))
        chosen += own[:most - len(chosen)]
    kept = sample.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id long")), "doc_id")

    known = whole_texts.own_words(kept)
    counted = whole_texts.frequencies(docs, known, telling)  # a row for each word of the examples and each term
    total = counted.get(b"\0", 0)
    idf = np.array([math.log(1 + total / (1 + counted.get(b"\0%d" % k, 0))) for k in range(len(terms))])
    weights = whole_texts.Weights({w: counted.get(w, 0) for w in known}, total)
    told = {r["doc_id"]: (tuple(r["terms"]), tuple(r["counts"])) for r in vectors(sample, terms).toLocalIterator()}
    groups: dict[tuple, list[int]] = {}
    for i, key in told.items():
        groups.setdefault(key, []).append(i)
    protos = [(*key, sum(every[i] for i in own), sum(1 - every[i] for i in own), min(own)) for key, own in groups.items()]
    index = BlockMaxIndex(protos, idf)
    number = {p[:2]: k for k, p in enumerate(index.protos)}
    prior = (sum(every.values()) + 0.05) / (len(every) + 1) if every else 0.0

    found = whole_texts.vectors(kept, weights).orderBy("doc_id").toArrow()
    ids, toxic = found.column("doc_id").to_pylist(), found.column("toxic").to_pylist()
    wholes = [(np.frombuffer(i.as_py(), np.int32).astype(np.int64), np.frombuffer(w.as_py(), np.float32).astype(float))
              for i, w in zip(found.column("ids"), found.column("weights"))]
    of = {label: sum(t == label for t in every.values()) / max(1, sum(t == label for t in toxic)) for label in (0, 1)}
    model = Model(index, ([], []), prior, terms, weights, whole_texts.WholeTexts(wholes, len(weights.ids)), np.array(toxic, float), ids,
                  [dict(zip(*index.weights(*told[i]))) for i in ids], np.array([of[t] for t in toxic], float))
    x, y, w = [], [], []
    for label in (1, 0):
        own = sorted((k for k in range(len(ids)) if toxic[k] == label), key=lambda k: xxhash.xxh64_intdigest(str(ids[k]), 3))[:MAX_CALIBRATION // 2]
        for k in own:
            key = told[ids[k]]
            x.append(model.votes(wholes[k], *key, leave=(k, number[key], label))[0])
            y.append(float(label))
            w.append(sum(t == label for t in every.values()) / len(own))
    model.knots = isotonic(x, y, w)
    return model


def score(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence, similarity.

    score depends on the text alone, so equal texts score alike; null and empty texts have no
    words and score like other texts without telling terms.  evidence lists the doc_ids of the
    nearest examples, whole texts first, similarity what they were found by.  Labels other
    than 0 and 1 are skipped; a document labelled twice counts as toxic if any label says
    so.  Without usable labels every score is 0.  A null doc_id is not held out.  Repeated
    rows give repeated rows; an empty table gives none.  Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_examples))  # max_examples bounds it

    def run(batches):
        scorer = Scorer(sent.value)
        for b in batches:
            out = [scorer(t) for t in texts(b)]
            yield record_batch(_SCORE, {"doc_id": b.column("doc_id").to_pylist(), "score": [x[0] for x in out],
                                        "evidence": [x[1] for x in out], "similarity": [x[2] for x in out]})

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ddl(_SCORE))
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "similarity"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; nothing is shuffled.

    Null and empty texts score like others without telling terms.  Repeated rows go or stay together.
    Without usable labels all rows stay; an empty table gives an empty one.  Columns may have
    any names besides doc_id and text; they are carried, not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        scorer = Scorer(sent.value)
        for b in batches:
            yield b.filter(np.array([scorer(t)[0] < threshold for t in texts(b)], bool))

    return docs.mapInArrow(run, docs.schema)
