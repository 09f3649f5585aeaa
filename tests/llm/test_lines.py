"""Repeated lines against a count of all keys: both ways of dropping, with and without filter."""

import random
from collections import Counter

import numpy as np
import pytest

from voltaic.llm import lines

from .helpers import DOCS, extra, frame

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, min_chars=1, keep="none"):
    """(doc_id, n_lines, n_dropped, text) of every (doc_id, text)."""
    key = lambda x: x.strip(WHITE).translate(LOWER)
    split = [(t or "").split("\n") for _, t in rows]
    docs = Counter(k for ls in split for k in {key(x) for x in ls} if len(k) >= min_chars)
    often = {k for k, n in docs.items() if n >= min_docs}
    first = {}
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0))
    for r in order:
        for n, x in enumerate(split[r]):
            first.setdefault(key(x), (r, n))
    out = []
    for r, ((i, _), ls) in enumerate(zip(rows, split)):
        kept = [x for n, x in enumerate(ls) if key(x) not in often or (keep == "first" and first[key(x)] == (r, n))]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    common = ["Share this Page", "  share THIS page\t", "é É", "\x0b漢字 ", "x", "", "   ", " nbsp", " em"]
    make = lambda: rng.choice(common) if rng.random() < 0.4 else f"line {rng.randrange(60)} {'w' * rng.randrange(5)}"
    return [None if rng.random() < 0.03 else "\n".join(make() for _ in range(rng.randrange(9))) for _ in range(n)]


@pytest.mark.parametrize("way", [{}, {"max_sent": 0}, {"max_filter_bits": 0}, {"max_sent": 0, "max_filter_bits": 0}])
@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (10, 1), (4, 3)])
def test_against_counts(spark, way, keep, min_docs, min_chars):
    texts = corpus(min_docs)
    found = lines.drop_repeated(frame(spark, texts, parts=5), min_docs, min_chars, keep, **way)
    assert got(found) == brute(list(enumerate(texts)), min_docs, min_chars, keep)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With one tiny segment nearly every place is met twice; the exact count decides."""
    monkeypatch.setattr(lines, "LEAST_BITS", 0)
    texts = corpus(3)
    assert got(lines.drop_repeated(frame(spark, texts), 4, max_filter_bits=64, segment_bits=64)) == brute(list(enumerate(texts)), 4)


def test_the_filter_keeps_once_seen_keys_back(spark):
    texts = [f"only {k}\nboth {k // 2}" for k in range(2000)]
    rows = lines._key_rows(frame(spark, texts, parts=7))
    bits = lines.seen_twice(rows, 1, 1, flush=50)
    sent = spark.sparkContext.broadcast(bits)
    n = lines.suspects(rows, sent, 1, False).count()
    assert 2000 <= n < 2100, n  # every repeated key, and few others
    assert np.unpackbits(bits).sum() >= 1000


def test_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert lines.drop_repeated(empty).count() == 0
    rows = [(None, "same\nown"), (1, "same\nown"), (1, "same\nown"), (2, None), (3, "")]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS)
    assert got(lines.drop_repeated(df, 3)) == brute(rows, 3)
    # Rows repeated in id and text keep a first occurrence alike.
    assert [r[2] for r in got(lines.drop_repeated(df, 3, keep="first"))] == [0, 0, 0, 0, 2]
    assert lines.drop_repeated(extra(spark, ["a"] * 3), 2).columns == ["doc_id", "n_lines", "n_dropped", "text"]
    long = "\n".join(f"row {k}" for k in range(50_000))
    assert [r[1:3] for r in got(lines.drop_repeated(frame(spark, [long, long + "\nmore"]), 2))] == [(50_000, 50_000), (50_001, 50_000)]
    for bad in ({"min_docs": 1}, {"min_chars": 0}, {"keep": "last"}):
        with pytest.raises(ValueError):
            lines.drop_repeated(df, **bad)
