import math
import random
import re
from collections import Counter

import pytest

from voltaic.llm import urls as x


def brute_split(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):])[0]


def brute_rule(host, path):
    fit = [(len(r), r, v) for r, v in x.RULES for h, s in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + s)]
    return max(fit)[1:] if fit else (None, None)


URLS = ["https://www.Example.com/en/1?x#y", "http://a.www.example.com/en/", "http://xexample.com/en/2", "http://example.com/en", "http://example.com", "http://com/x",
        "http://a.net/es/1", "http://a.net/de/1", "no scheme", None, "", "://", "a://b://c/d", "http://h?q/", "http://h#f/", "HTTP://U@H.NET:80/fr/É?a", "x://y\n/z\nw"]


def some(n=400):
    r = random.Random(1)
    return [f"http://{r.choice(['blog', 'm', 'www'])}.{r.choice(['good', 'fine', 'nice'])}{r.randint(0, 99)}.com/fr/{r.randint(0, 999)}" if r.random() < .5 else
            f"http://cheap-bets{r.randint(0, 99)}.net/es/{r.randint(0, 99)}" for _ in range(n)]


@pytest.fixture(scope="module")
def judged(spark):
    data = URLS + some() + ["http://nice5.org/fr/7", "http://cheap-bets3.org/es/1"]
    df = spark.createDataFrame([(k, u, 0.5, "x") for k, u in enumerate(data)], "page_id long, url string, score double, host string").repartition(3)
    return data, {r.page_id: r for r in x.judge(df).collect()}


def test_rules(judged):
    data, got = judged
    for k, u in enumerate(data):
        host, path = brute_split(u)
        rule, verdict = brute_rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule), u
        assert got[k].verdict == verdict if verdict else got[k].verdict in ("allow", "block")
    assert got[len(data) - 2].verdict == "allow" and got[len(data) - 1].verdict == "block"


def test_scores_are_the_model(spark, judged):
    data, got = judged
    import zlib
    simple = lambda h, p: "^" * x.ORDER + re.sub("[^a-z0./_-]", "?", "".join("0" if "1" <= c <= "9" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in h + p)) + "$"
    texts = {k: simple(*brute_split(u)) for k, u in enumerate(data)}
    n = {"allow": Counter(), "block": Counter()}
    for k, t in texts.items():
        v = brute_rule(*brute_split(data[k]))[1]
        if v and zlib.crc32(t.encode()) % 5:
            for i in range(x.ORDER, len(t)):
                for c in range(x.ORDER + 1):
                    n[v]["g", t[i - c:i + 1]] += 1
                    n[v]["h", t[i - c:i]] += 1

    def prob(v, t, i):
        p = None
        for c in range(x.ORDER + 1):
            g, h = n[v]["g", t[i - c:i + 1]], n[v]["h", t[i - c:i]]
            p = (g + x.ALPHA) / (h + x.ALPHA * x.SYMBOLS) if not c else (g + x.LAMBDA * p) / (h + x.LAMBDA)
        return p
    for k, t in texts.items():
        want = sum(math.log(prob("allow", t, i) / prob("block", t, i)) for i in range(x.ORDER, len(t))) / (len(t) - x.ORDER)
        assert abs(got[k].score - want) < 1e-9, data[k]


def test_edges_of_input(spark):
    df = spark.createDataFrame([(None, "http://a.org/"), (1, "http://a.org/"), (1, "http://a.org/" + "long/" * 20_000)], "page_id long, url string")
    rows = x.judge(df).collect()
    assert len(rows) == 3 and all(r.verdict == "allow" for r in rows)
    assert x.judge(df.limit(0)).count() == 0


def test_registered_query_reads_whole_urls(spark, tmp_path):
    import zlib

    from voltaic.llm.queries import QUERIES
    r = random.Random(3)
    data = [f"{u}?{'ref=news' if '.com' in u else 'bonus=win&x'}{r.randint(0, 9)}#{'top' if '.com' in u else 'bet%20now'}" for u in some()] + URLS
    data += ["https://nice5.org/fr/7?ref=news1#top", "https://nice5.org/fr/7?bonus=win&x1#bet%20now", "https://nice5.org/fr/7", "plain text", "bonus=win"]
    spark.createDataFrame([(k, u) for k, u in enumerate(data)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {p.page_id: p for p in QUERIES["op5_urls"](spark, str(tmp_path)).collect()}
    assert len(got) == len(data)
    at = len(data) - 5
    assert got[at].score > got[at + 2].score > got[at + 1].score and got[at + 3].score != got[at + 4].score
    simple = lambda u: "^" * x.ORDER + re.sub("[^a-z0./_?#=&%-]", "~", "".join("0" if "1" <= c <= "9" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in u or "")) + "$"
    texts = [simple(u) for u in data]
    n = {"allow": Counter(), "block": Counter()}
    for u, t in zip(data, texts):
        v = brute_rule(*brute_split(u))[1]
        if v and zlib.crc32(t.encode()) % 5:
            for i in range(x.ORDER, len(t)):
                for c in range(x.ORDER + 1):
                    n[v]["g", t[i - c:i + 1]] += 1
                    n[v]["h", t[i - c:i]] += 1

    def prob(v, t, i):
        p = None
        for c in range(x.ORDER + 1):
            g, h = n[v]["g", t[i - c:i + 1]], n[v]["h", t[i - c:i]]
            p = (g + x.ALPHA) / (h + x.ALPHA * 39) if not c else (g + x.LAMBDA * p) / (h + x.LAMBDA)
        return p
    for k, t in enumerate(texts):
        assert (got[k].host, got[k].path) == brute_split(data[k])
        want = sum(math.log(prob("allow", t, i) / prob("block", t, i)) for i in range(x.ORDER, len(t))) / (len(t) - x.ORDER)
        assert abs(got[k].score - want) < 1e-9, data[k]
