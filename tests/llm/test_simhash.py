import random
import re

import numpy as np
import pytest
import xxhash

from voltaic.llm import simhash

from .helpers import extra, frame


def brute_fp(text):
    ws = [w for w in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    sh = [" ".join(ws[k:k + 4]) for k in range(len(ws) - 3)] or ([" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def some_texts(n=120, seed=3):
    r = random.Random(seed)
    vocab = ["Wort%d" % k for k in range(200)] + ["Ähre", "ñandú", "A"]
    base = [" ".join(r.choice(vocab) for _ in range(r.randint(1, 150))) for _ in range(n)]
    near = [t.replace("Wort7 ", "Wort8 ", 1) for t in base[:60]]
    return base + near + base[:10] + ["", None, "  \n\t", "one", "ONE two\nthree", "ein Wort bleibt eins und mehr"]


def test_fingerprint_is_the_definition():
    for t in some_texts(40):
        assert simhash.fingerprint(None if t is None else t.encode()) == brute_fp(t)


def test_long_text_in_parts():
    t = " ".join("w%d" % (k % 5000) for k in range(40_000))
    assert simhash.fingerprint(t.encode()) == brute_fp(t)


@pytest.mark.parametrize("tile_rows", [7, 1000])
def test_components_match_brute_force(spark, tile_rows):
    texts = some_texts()
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, texts), radius=8, tile_rows=tile_rows).collect()}
    fps = [brute_fp(t) for t in texts]
    roots = brute_components(fps, 8)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, i), i)
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i].fp % 2**64 == fps[i]
        assert got[i].component_id == least[roots[i]]


def test_tiles_lose_no_link():
    r = np.random.default_rng(1)
    seeds = r.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds ^ (np.uint64(1) << np.uint64(b)) for b in range(0, 60, 3)] + [seeds]))
    u, v = simhash.compare_tiles(fps, None, 4, block=16)
    assert len(u) <= len(fps)
    half = fps[::2], fps[1::2]
    u2, v2 = simhash.compare_tiles(*half, 4, block=16)
    for a, b in ((u, v), (u2, v2)):
        assert set(a.tolist()) <= set(fps.tolist()) and set(b.tolist()) <= set(fps.tolist())
    roots = brute_components(fps.tolist(), 4)
    assert len(fps) - len(u) == len(set(roots))


def test_chain_and_star_components(spark):
    chain = [(k, k + 1) for k in range(50)]
    star = [(1000, 1000 + k) for k in range(1, 60)] + [(2000, 1059)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain + star + [(5, 5)], "u long, v long")).collect()}
    assert all(got[k] == 0 for k in range(1, 51))
    assert all(got[k] == 1000 for k in [*range(1001, 1060), 2000])


def test_edges_of_input(spark):
    t = "the same words in the same order every time here"
    df = extra(spark, [t, t, t, None, "", None, t + " x", t], ids=[5, 5, None, 7, None, 8, 9, 3])
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == 8
    by_fp = {}
    for r in rows:
        by_fp.setdefault(r.fp, set()).add(r.component_id)
    assert by_fp[0] == {7}
    assert all(len(c) == 1 for c in by_fp.values())
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id, r.text) for r in kept.where("text is not null").collect())
    assert got[0] == (3, t)
    assert kept.where("doc_id = 7").count() == 1
    assert simhash.keep_one(frame(spark, [t, t, t], ids=[1, 1, 1])).count() == 1
    assert simhash.near_duplicates(frame(spark, ["a"]).limit(0)).count() == 0
    assert simhash.near_duplicates(frame(spark, [None, "a b"], ids=[None, None])).where("component_id is null").count() == 2


@pytest.mark.parametrize("order", ["ordered", "shuffled", "zigzag"])
def test_edges_never_grow(spark, order, monkeypatch):
    """Chains of 5,000 nodes: no step holds more edges than the chain has."""
    import random
    ids = list(range(5000))
    if order == "shuffled":
        random.Random(1).shuffle(ids)
    if order == "zigzag":
        ids = [k // 2 if k % 2 else 4999 - k // 2 for k in range(5000)]
    most, delete = [], simhash.delete_path

    def counted(spark, path):
        df = spark.read.parquet(path)
        most.append(df.count() if "hi" in df.columns else 0)
        delete(spark, path)
    monkeypatch.setattr(simhash, "delete_path", counted)
    roots = simhash.components(spark.createDataFrame(list(zip(ids, ids[1:])), "u long, v long").repartition(4))
    assert {(r.node, r.root) for r in roots.collect()} == {(k, 0) for k in range(1, 5000)}
    assert max(most) <= 4999 and len(most) < 80


def test_one_is_kept_with_any_columns(spark):
    texts = ["the same words again and again here", "the same words again and again here", "other text altogether, with nothing alike at all", None, ""]
    df = frame(spark, texts).selectExpr("*", "doc_id as _keep_id", "doc_id as keep_id", "text as keep_row", "1 as _keep_row", "2 as KEEP_KEY")
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 3]
