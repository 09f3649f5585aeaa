"""URL filter: host and path rules, and a character language-model ratio for the rest.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, give every URL
the mean log-likelihood difference per character.  URLs that a rule allows or blocks are the
examples; a fifth of them is held back to calibrate the cutoff.  Everything is DataFrame
operations: counts are one aggregation over all character windows, and models are tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.stage import stage

#: host + path, verdict: fixed values.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Symbols the models know: a-z, 0 for any digit, . / - _ , ? for the rest, and the two ends.
SYMBOLS = 26 + 1 + 4 + 1 + 2
#: For whole URLs: a-z, 0, . / - _ , ? # = & % , ~ for the rest, and the two ends.
WHOLE_SYMBOLS = 26 + 1 + 4 + 5 + 1 + 2
#: Longest context, in characters.  A table of windows has WHOLE_SYMBOLS ** (ORDER + 1) rows at most.
ORDER = 3
#: Weight of the next shorter context, and of every symbol in the shortest.
LAMBDA, ALPHA = 4.0, 0.5
#: Share of held-back accepted URLs that the cutoff may turn away.
FALSE_BLOCK = 0.01

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, start = name.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def simplified(host: Column, path: Column) -> Column:
    """host and path over the models' symbols, between marks of their ends."""
    text = F.translate(F.concat(host, path), _UPPER + "123456789", _LOWER + "0" * 9)
    return F.concat(F.lit("^" * ORDER), F.regexp_replace(text, r"[^a-z0./_-]", "?"), F.lit("$"))


def simplified_whole(url: Column) -> Column:
    """The whole URL, null as empty, over the models' symbols for it, between marks of its ends."""
    text = F.translate(F.coalesce(url, F.lit("")), _UPPER + "123456789", _LOWER + "0" * 9)
    return F.concat(F.lit("^" * ORDER), F.regexp_replace(text, r"[^a-z0./_?#=&%-]", "~"), F.lit("$"))


def windows(text: Column) -> Column:
    """Every character with its ORDER predecessors."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - ORDER), lambda k: F.substring(text, k, ORDER + 1))


def model(counts: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(gram, ratio): log of accepted over rejected probability of the last character of every
    window, from counts (gram, acc, rej).

    P(c | h) = (n(hc) + LAMBDA P(c | h')) / (n(h) + LAMBDA), h' one character shorter; the
    empty context has (n(c) + ALPHA) / (n + ALPHA symbols).  Unseen contexts thus fall back.
    """
    sums = [F.sum(k).cast("double").alias(k) for k in ("acc", "rej")]
    total = counts.agg(*sums).first()
    out = counts.select("gram")
    probability = {k: None for k in ("acc", "rej")}
    for n in range(ORDER + 1):  # length of the context
        seen, context = F.substring("gram", ORDER + 1 - n, n + 1), F.substring("gram", ORDER + 1 - n, n)
        here = counts.groupBy(seen.alias("s")).agg(*[x.alias(f"{k}_{n}") for k, x in zip(("acc", "rej"), [F.sum("acc"), F.sum("rej")])])
        # WHOLE_SYMBOLS ** (ORDER + 1) rows of some 40 bytes at most, about 90 MB
        out = out.join(F.broadcast(here), seen == F.col("s")).drop("s")
        if n:
            before = counts.groupBy(context.alias("h")).agg(F.sum("acc").alias(f"acc_h{n}"), F.sum("rej").alias(f"rej_h{n}"))
            out = out.join(F.broadcast(before), context == F.col("h")).drop("h")
        for k in ("acc", "rej"):
            count = F.col(f"{k}_{n}").cast("double")
            probability[k] = ((count + ALPHA) / ((total[k] or 0.0) + ALPHA * symbols) if not n
                              else (count + LAMBDA * probability[k]) / (F.col(f"{k}_h{n}") + LAMBDA))
    return out.select("gram", (F.log(probability["acc"]) - F.log(probability["rej"])).alias("ratio"))


def judge(pages: DataFrame, rules=RULES, false_block: float = FALSE_BLOCK, whole: bool = False) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score, cutoff.

    score is the mean log-likelihood difference per character, the end included (positive:
    closer to accepted URLs).  A page under no rule is blocked if its score is below the cutoff: the
    ``false_block`` quantile of held-back accepted URLs, or 0 without any.  The models read the
    URL from its scheme to its fragment if ``whole``, host and path only otherwise.  A URL that
    is null or has no :// has an empty host and path and is judged like any other.  Repeated rows
    give repeated rows, an empty table none; a null page_id stays null; other columns are not
    read.
    """
    url = F.col("url").cast("string")
    base = (pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                         *([simplified_whole(url).alias("text")] if whole else []))
            .withColumn("text", F.col("text") if whole else simplified(F.col("host"), F.col("path"))))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("said", said)
    held = F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(5)) == 0
    base = base.withColumn("fold", F.when(F.col("said").isNull(), "open").when(held, "held").otherwise("fit"))
    each = base.withColumn("row", F.monotonically_increasing_id())
    grams = each.select("fold", "said", F.explode(windows(F.col("text"))).alias("gram"))
    is_in = lambda what: F.sum(((F.col("fold") == "fit") & (F.col("said") == what)).cast("long"))
    counts = stage(grams.groupBy("gram").agg(F.coalesce(is_in("allow"), F.lit(0)).alias("acc"),
                                             F.coalesce(is_in("block"), F.lit(0)).alias("rej")), "url-counts")
    ratios = stage(model(counts, WHOLE_SYMBOLS if whole else SYMBOLS), "url-model")
    kept = ["page_id", "host", "path", "rule", "said", "fold"]
    scored = stage(each.select("row", *kept, F.explode(windows(F.col("text"))).alias("gram"))
                   .join(F.broadcast(ratios), "gram")  # bounded as above
                   .groupBy("row").agg(*[F.first(k).alias(k) for k in kept], F.avg("ratio").alias("score")), "url-scores")
    cut = scored.where("fold = 'held' and said = 'allow'").agg(F.percentile_approx("score", F.lit(false_block), F.lit(10_000)).alias("c")).first()["c"]
    cut = 0.0 if cut is None or math.isnan(cut) else float(cut)
    verdict = F.coalesce("said", F.when(F.col("score") < cut, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", F.lit(cut).alias("cutoff"))
