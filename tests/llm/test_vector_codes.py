"""Vector codes against a plain k-means in Python integers; the grid against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from voltaic.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, q array<long>"


def brute(rows, parts=16, entries=64, rounds=2):
    """{row: (vec_id, code, error, label_error)}, digest; rows of (vec_id, vector, label)."""
    fine = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(fine[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in fine]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[0], []).append(c[p])
            books[p] = [[sum(col) // len(groups[e]) for col in zip(*groups[e])] if e in groups else x for e, x in enumerate(books[p])]
    out, by_label = [], {}
    for (i, _, l), c in zip(fine, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append([i, l, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)])
        by_label[l] = by_label.get(l, 0) + out[-1][3]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, c, e, by_label[l]) for i, l, c, e in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


def vectors(seed, n, width, spread=1.0):
    rng = random.Random(seed)
    f = lambda x: float(np.float32(x))
    rows = [(k, [f(rng.gauss(0, spread)) for _ in range(width)], rng.choice([None, 1, 2])) for k in range(n)]
    return rows + [(n, rows[0][1], 1), (n + 1, rows[0][1], 2)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, [1]) for r in rows], SCHEMA).repartition(3)


def got(df, books):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error").collect()), key=repr), vc.books_digest(books)


@pytest.mark.parametrize("n,width,spread", [(300, 64, 0.2), (90, 16, 1.0), (30, 32, 5.0), (100, 48, 1e6)])
def test_against_plain_integers(spark, n, width, spread):
    rows = vectors(n, n, width, spread)
    assert got(*vc.compress(frame(spark, rows))) == brute(rows)


def test_dropped_rows_repeats_and_null_ids(spark):
    rows = vectors(1, 80, 16)
    bad = [(200, None, 1), (201, [None] + [0.0] * 15, 1), (202, [float("nan")] + [0.0] * 15, None), (203, [float("-inf")] + [0.0] * 15, 2)]
    more = [(5, rows[3][1], 1), (5, rows[5][1], rows[5][2]), (None, rows[7][1], None), (-4, rows[9][1], 2)]
    assert got(*vc.compress(frame(spark, rows + bad + more))) == brute(rows + more)
    odd = [(300, [1.0] * 32, 1), (301, [], 1)]  # not the commonest length
    assert got(*vc.compress(frame(spark, rows + odd))) == brute(rows)


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1)]):
        coded, books = vc.compress(frame(spark, rows))
        assert coded.count() == 0 and not books.size
    with pytest.raises(ValueError):
        vc.compress(frame(spark, [(1, [1.0] * 17, 1)]))


def test_huge_components_saturate(spark):
    rows = [(k, [3e38 if k % 2 else -3e38] + [float(k)] * 15, k % 3) for k in range(70)]
    coded, _ = vc.compress(frame(spark, rows))
    assert {r["error"] for r in coded.collect()} == {0} or coded.count() == 70


@pytest.mark.parametrize("width,cells,most", [(4, 4096, 16_384), (4, 4096, 5), (1, 64, 100), (20, 4096, 100), (3, 1, 10)])
def test_cells_find_the_nearest_of_all_entries(width, cells, most):
    rng = np.random.default_rng(width)
    book = rng.integers(-60, 60, (64, width))
    book[40:44] = book[3]  # equal entries: the lowest index wins
    search = vc.Cells(book, cells, most)
    for spread in (50, 400, 1 << 38):
        x = rng.integers(-spread, spread + 1, (700, width))
        x[:64] = book
        code, dist = search.nearest(x)
        d = ((x.astype(object)[:, None] - book.astype(object)[None]) ** 2).sum(2)
        want = np.array([list(r).index(min(r)) for r in d])
        assert (code == want).all() and (dist == d[np.arange(len(x)), want]).all()


def test_cells_save_distances():
    rng = np.random.default_rng(0)
    book = rng.integers(-60, 60, (64, 4))
    search = vc.Cells(book)
    for _ in range(5):
        search.nearest(rng.integers(-60, 60, (8000, 4)))
    assert search.evaluated < 0.3 * 64 * 40_000 and len(search.known) <= 9 ** 4
