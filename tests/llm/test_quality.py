import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from voltaic.llm import quality as x

from .helpers import extra, frame

LABELS = "doc_id long, quality int, toxic int"


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    c = Counter(wins)
    rep = {p for k, g in enumerate(wins) if c[g] > 1 for p in (k, k + 1, k + 2)}
    lines = t.split("\n")
    dup = sum(1 for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:k])
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t|#\x0b\x1c\x85\xa0A!"), max_size=80))
def test_measures_random(t):
    assert x.measure(t.encode())[:5] == brute(t)


def test_binomial_tail_is_exact():
    for n, k, p in [(10, 2, .5), (200, 3, .05), (3000, 0, .003), (50, 0, .1)]:
        want = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        assert abs(x.binomial_tail(k, n, p) - want) < 1e-12
    assert x.binomial_tail(10, 10, .1) == 1.0


def test_choice_keeps_its_guarantee():
    r = random.Random(1)
    broken = 0
    for _ in range(200):  # true rates of false rejection by cutoff; a cutoff above its share must not be chosen
        share = x.LIMIT / len(x.RULES)
        rates = [share * 3, share * 1.2, share / 20] + [0] * (len(x.CUTOFFS) - 3)
        n, reached = 6000, [0] * (len(x.CUTOFFS) + 1)
        for _ in range(n):
            u = r.random()
            reached[sum(u < q for q in rates)] += 1
        cut = x.choose({(0, "symbols"): reached}).get((0, "symbols"))
        broken += cut is not None and cut < x.CUTOFFS[2]
    assert broken <= 2
    assert x.choose({(0, "symbols"): [5] + [0] * len(x.CUTOFFS)}) == {}


def test_rows_and_strata(spark):
    r = random.Random(3)
    good = [" ".join("w%d" % r.randint(0, 10**6) for _ in range(r.randint(60, 99))) for _ in range(3500)]
    junk = [" ".join("w%d###" % r.randint(0, 10**6) for _ in range(80)) for _ in range(50)]
    few = ["x y", None, "", "a b c " * 5000]
    texts = good + junk + few
    labels = spark.createDataFrame([(k, int(k < len(good)), 0) for k in range(len(texts))] + [(1, 1, 0), (None, 1, 0), (2, None, 0)], LABELS)
    rows = {q.doc_id: q for q in x.judge(frame(spark, texts), labels).collect()}
    assert len(rows) == len(texts)
    for k in random.Random(5).sample(range(len(texts)), 300):
        q = rows[k]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute(texts[k])
    assert all(rows[k].kept for k in range(len(good)))
    assert not any(rows[k].kept for k in range(len(good), len(texts)))
    assert "symbols" in rows[len(good)].failed_rules
    last = rows[len(texts) - 1]
    assert last.base_failed and last.n_repeat_words == last.n_words == 15_000


def test_edges_of_input(spark):
    none = spark.createDataFrame([], LABELS)
    rows = x.judge(extra(spark, [" ".join("ab%d" % k for k in range(60)), None, ""], ids=[None, 1, 1]), none).collect()
    assert sorted(q.kept for q in rows) == [False, False, True]
    assert x.judge(frame(spark, ["a"]).limit(0), none).count() == 0
