"""Quality rules with risk-controlled thresholds.

Every rule rejects texts whose measure reaches a cutoff.  Cutoffs are chosen for each stratum
(by length) on labelled documents: a cutoff is safe if the exact binomial test rejects "this
rule turns away more than its share of good documents" at a level corrected for all tests
(Bonferroni over strata, rules and cutoffs).  The lowest safe cutoff is used; where none is
safe, as with few labels, the rule is off in that stratum.  The shares of all rules add up
to the limit, so with the stated confidence no stratum loses more than ``limit`` of its good
documents to the method.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.stage import stage
from .common import map_rows, spaced_words

#: Largest share of a stratum's good documents that the method may turn away, and the
#: probability that any stratum exceeds it.
LIMIT, ERROR = 0.02, 0.05
#: Lower ends of the strata, in words.
STRATA = (0, 100, 300, 1000)
#: Cutoffs that are tried for every rule.
CUTOFFS = (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.8)
RULES = ("symbols", "capitals", "bangs", "repeats", "same_lines", "top_word")

_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in _SYMBOLS)
_NOT_CAPITALS = bytes(c for c in range(256) if not 65 <= c <= 90)

_MEASURES = {"doc_id": "long", "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
             "n_repeat_words": "long", **{r: "double" for r in RULES}}


def measure(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rules' measures."""
    if not text:
        return (0,) * 5 + (0.0,) * len(RULES)
    ws = spaced_words(text)
    n = len(ws)
    chars = len(text.decode()) - (len(text) - sum(map(len, ws)))
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    lines, seen, dup = 0, set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = 0
    if n > 2:
        windows = list(zip(ws, ws[1:], ws[2:]))
        count = Counter(windows)
        if len(count) < len(windows):
            covered = 0  # words before this one are counted
            for k, w in enumerate(windows):
                if count[w] > 1:
                    repeat += k + 3 - max(k, covered)
                    covered = k + 3
    capitals = len(text.translate(None, _NOT_CAPITALS))
    top = Counter(ws).most_common(1)[0][1] if ws else 0
    each = max(n, 1)
    return (n, chars, symbols, dup, repeat, symbols / max(chars, 1), capitals / max(chars, 1), text.count(b"!") / each,
            repeat / each, dup / max(lines, 1), top / each)


def measures(docs: DataFrame) -> DataFrame:
    return map_rows(docs, _MEASURES, lambda: measure)


def stratum(n_words="n_words") -> Column:
    return reduce(lambda a, b: a + b, [(F.col(n_words) >= x).cast("int") for x in STRATA[1:]])


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), summed from k down; at k >= n p it is only bounded by 1."""
    if k >= n * p:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total, i = 0.0, k
    while i >= 0 and term > total * 1e-17:
        total += term
        term *= i * (1 - p) / ((n - i + 1) * p)
        i -= 1
    return min(1.0, total)


def choose(good: dict[tuple[int, str], list[int]], limit: float = LIMIT, error: float = ERROR) -> dict[tuple[int, str], float]:
    """The lowest safe cutoff of each (stratum, rule), from counts of good documents by the
    number of cutoffs that their measure reaches; without a safe one there is no entry."""
    share, level = limit / len(RULES), error / (len(STRATA) * len(RULES) * len(CUTOFFS))
    out = {}
    for key, reached in good.items():
        n = sum(reached)
        for c, cutoff in enumerate(CUTOFFS):
            if binomial_tail(sum(reached[c + 1:]), n, share) <= level:
                out[key] = cutoff
                break
    return out


def fit(found: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> dict[tuple[int, str], float]:
    """Cutoffs from all labelled documents; the driver sees counts by stratum, rule and cutoff."""
    fine = (labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    reached = lambda r: reduce(lambda a, b: a + b, [(F.col(r) >= c).cast("int") for c in CUTOFFS])
    rows = (found.join(fine, "doc_id", "left_semi")
            .select(stratum().alias("s"), F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), reached(r).alias("c")) for r in RULES])).alias("x"))
            .groupBy("s", "x.rule", "x.c").agg(F.count(F.lit(1)).alias("n")).collect())
    good: dict[tuple[int, str], list[int]] = {}
    for r in rows:
        good.setdefault((r["s"], r["rule"]), [0] * (len(CUTOFFS) + 1))[r["c"]] += r["n"]
    return choose(good, limit, error)


def judge(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, the rules' measures, base_failed, failed_rules, kept.

    Null and empty texts have no words and fail the base rule (under 50 words).  Documents
    labelled good several times count once; other quality values are not read.  Without
    labels no rule is safe and the base rule decides.  Repeated rows give repeated rows, an
    empty table none; a null doc_id stays null and has no label; other columns are not read.
    """
    found = stage(measures(docs), "quality")
    cuts = fit(found, labels, limit, error)
    failed = [F.when((stratum() == s) & (F.col(rule) >= c), F.lit(rule)) for (s, rule), c in sorted(cuts.items())]
    rules = F.array_distinct(F.array_compact(F.array(*failed))) if failed else F.expr("cast(array() as array<string>)")
    return (found.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .withColumn("failed_rules", rules)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))
