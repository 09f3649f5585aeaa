import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voltaic.llm import secrets as x

from .helpers import extra, frame


def brute(t):
    t, out = t or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return sorted(out)


def brute_entropy(s, w=20):
    best = 0.0
    for k in range(len(s) - w + 1):
        best = max(best, -sum(c / w * math.log2(c / w) for c in Counter(s[k:k + w]).values()))
    return best


def texts():
    r = random.Random(9)
    bits = ["password", "Token", "API_KEY", "apikey", "secret", ": ", "=", " = ", "'", '"', "AKIA", "ABCD0123EF", "deadbeef", "0123456789abcdef", " ", "é", "\n", "x", "==", "token:", "abcdefgh", "🙂"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(500)] + [
        "secret:token:abcdefgh token=token=abcdefgh", "AKIAAKIA" + "A" * 15, "tokeN = \"1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae\"", "", None, "paſsword=abcdefgh"]


def test_base_is_the_definition(spark):
    data = texts()
    rows = {r.doc_id: r for r in x.find(extra(spark, data)).collect()}
    assert sum(len(brute(t)) for t in data) > 200
    for k, t in enumerate(data):
        assert [tuple(b) for b in rows[k].base] == brute(t), t
        for m in rows[k].more:
            assert not any(a < m.end and m.start < b for a, _, b in brute(t))


def test_window_entropy_is_exact(spark):
    r = random.Random(2)
    data = ["".join(r.choice(a) for _ in range(r.randint(15, 60))) for a in ("ab", "0123456789abcdef", x._SYMBOLS) for _ in range(20)] + ["A" * 40]
    got = spark.createDataFrame(list(enumerate(data)), "k int, s string").select("k", x.max_entropy(F.col("s")).alias("e")).collect()
    for q in got:
        assert q.e == pytest.approx(brute_entropy(data[q.k]), abs=1e-9)


def test_method_finds_random_strings(spark):
    r = random.Random(4)
    key = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    data = [f"see ü {key} there", "verylongordinarygermanwordungsheitkeitenschaft and more", "EXAMPLE" + key, "1" * 30 + "2" * 10, "550E8400-e29b-41d4-a716-446655440000".lower(), "a-long-path/of-plain/words-and-dashes/here"]
    rows = {q.doc_id: q for q in x.find(frame(spark, data)).collect()}
    assert [tuple(m) for m in rows[0].more] == [(6, 3, 46)]
    assert all(not rows[k].more for k in range(1, 6))


def test_edges_of_input(spark):
    rows = x.find(extra(spark, ["password=abcdef"] * 2 + [None, "a" * 200_000 + " token=abcdefg"], ids=[1, 1, None, 2])).collect()
    assert len(rows) == 4 and [len(r.base) for r in rows if r.doc_id == 1] == [1, 1]
    assert [[tuple(b) for b in r.base] for r in rows if r.doc_id == 2] == [[(0, 2, 200_000), (200_001, 0, 200_014)]]
    assert x.find(frame(spark, ["a"]).limit(0)).count() == 0


KEY = "Ab3dE9kLm2Pq7Rs5TuVw8XyZ"


def test_every_class_and_parts_of_candidates(spark):
    """(text, spans that must be found)"""
    data = [("qWxPzLmTrNvBgHyKuJcSdFo", ["qWxPzLmTrNvBgHyKuJcSdFo"]), ("83920174650192837465", ["83920174650192837465"]),
            (f"path/sample/{KEY}", [KEY]), (f"sample_key={KEY}1", [f"{KEY}1"]), (f"a {KEY} b", [KEY]), (f"{KEY}==", [KEY]),
            (f"see {KEY}/{KEY[::-1]}", [KEY, KEY[::-1]]), ("Zx9/Qw7+Er5/Ty3=Ui1/Op0+", ["Zx9/Qw7+Er5/Ty3=Ui1/Op0+"])]
    rows = {q.doc_id: q for q in x.find(frame(spark, [t for t, _ in data])).collect()}
    for k, (t, want) in enumerate(data):
        assert [t[m.start:m.end] for m in rows[k].more] == want, t


def test_the_allow_list_still_suppresses(spark):
    data = [f"EXAMPLE{KEY}", f"{KEY}EXAMPLE", f"your_{KEY}", f"xxxxxxxx{KEY}", "12345678901234567890", "abcdefghijklmnopqrstuvwxyz", "0" * 30,
            "550e8400-e29b-41d4-a716-446655440000", "some-long-path/of_plain/words-and-dashes/here", "-" * 60, "=" * 60, "_" * 20 + "=" * 20,
            "Donaudampfschifffahrtsgesellschaftskapitaen", "counterrevolutionaries", "Internationalisierungsbestrebungen"]
    assert [r.doc_id for r in x.find(frame(spark, data)).collect() if r.more] == []


def test_long_candidates_take_linear_time(spark):
    import time
    r = random.Random(1)
    took = []
    for n in (1, 100_000, 200_000, 1_000_000):
        t = "".join(r.choice(x._SYMBOLS[:62]) for _ in range(n))
        started = time.perf_counter()
        more = x.find(frame(spark, [t], parts=1)).first().more
        took.append(time.perf_counter() - started)
        assert [(m.start, m.end) for m in more] == ([(0, n)] if n > 20 else [])
    assert took[3] < 60 and took[2] < 2.5 * took[1] + 2, took


def test_many_matches_take_linear_time(spark):
    import time
    t = "0123456789abcdef01234567 " * 40_000
    started = time.perf_counter()
    base = x.find(frame(spark, [t], parts=1)).first().base
    assert [(b.start, b.end) for b in base] == [(25 * k, 25 * k + 24) for k in range(40_000)]
    assert time.perf_counter() - started < 60
