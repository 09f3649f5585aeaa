import random
import re

import pytest

from voltaic.llm import decontaminate as d

from .helpers import extra, frame

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def ws(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items):
    w, hit, found = ws(text), set(), set()
    for item, t in items:
        v = ws(t)
        n = min(13, len(v))
        for win in {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else ():
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) == win:
                    hit.update(range(p, p + n))
                    found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit) and 20 * len(hit) >= len(w)


def case(seed=5):
    r = random.Random(seed)
    vocab = ["the", "of", "Ähre", "x1", "Niño"] + ["v%d" % k for k in range(8)]
    item = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(k, item(r.choice([1, 3, 12, 13, 14, 20, 40]))) for k in range(25)] + [(40, None), (41, ""), (42, "...!"), (None, item(15)), (7, item(14))]
    texts = []
    for _ in range(60):
        parts = [item(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            src = r.choice(items)[1] or ""
            parts += [src.upper() if r.random() < .3 else src.replace(" ", ", "), item(r.randint(0, 60))]
        texts.append(" ".join(parts))
    return texts + ["", None, "!!", items[4][1] or "x"], items


@pytest.mark.parametrize("block_pairs,segment", [(100_000, 400_000), (40, 300)])
def test_matches_brute_force(spark, monkeypatch, block_pairs, segment):
    texts, items = case()
    monkeypatch.setattr(d, "build_index", lambda *a, f=d.build_index, **k: f(*a, segment_words=segment, **k))
    got = d.contamination(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string"), block_pairs=block_pairs).collect()
    assert len(got) == len(texts)
    assert any(r.n_hit for r in got)
    for r in got:
        assert (r.n_words, r.n_hit, r.items, r.contaminated) == brute(texts[r.doc_id], items), r
        assert r.n_items == len(r.items)


def test_whole_index_and_proximity(spark):
    phrase = " ".join("p%d" % k for k in range(13))
    moved = phrase.replace("p5 p6", "p6 p5")
    df = frame(spark, ["a b " + phrase, "q " + moved + " z", "p0 p12", None])
    index = d.build_index(df, gap=64)
    freq = {r.term: r.n for r in d.frequencies(index).collect()}
    assert freq["p0"] == 3 and freq["a"] == 1
    got = {r.doc_id: r for r in d.search(index, {phrase: ["9"]}, freq, slop=2).collect()}
    assert got[0].starts == [2] and got[0].ends == [15] and got[0].items == ["9"] and got[0].n_near == 0
    assert got[1].starts == [] and got[1].n_near == 1
    assert got[2].n_near == 0 and got[3].n_words == 0


def test_edges_of_input(spark):
    items = spark.createDataFrame([(1, "only three words", 3)], "item_id long, text string, n_words long")
    none = items.limit(0)
    df = extra(spark, ["only three words", "only three words", None, "Only THREE, words. " * 2000, "x"], ids=[1, 1, None, 4, None])
    rows = d.contamination(df, items).collect()
    assert sorted(r.contaminated for r in rows) == [False, False, True, True, True]
    assert max(r.n_hit for r in rows) == 6000
    kept = d.drop_contaminated(df, items)
    assert kept.columns == df.columns
    assert sorted(str(r.text) for r in kept.collect()) == ["None", "x"]
    assert d.contamination(df, none).where("contaminated").count() == 0
    assert d.contamination(df.limit(0), items).count() == 0


def test_registered_query_returns_near_matches(spark, tmp_path):
    import __spark_entry__ as E

    item = ["p%d" % k for k in range(26)]
    moved = item[:6] + [item[7], item[6]] + item[8:18] + [item[19], item[18]] + item[20:]  # no 13 words in a row survive
    put = item[:7] + ["new"] + item[7:19] + ["new"] + item[19:]
    frame(spark, [" ".join(item), "q " + " ".join(moved) + " z", " ".join(put), "p0 p5 p25", None]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(item)), (8, "other words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in E.queries()["op1_proximity"](spark, str(tmp_path)).collect()}
    exact = {r.doc_id: r for r in E.queries()["op1_decontamination"](spark, str(tmp_path)).collect()}
    assert [got[k].near_items for k in range(5)] == ["", "7", "7", "", ""]
    assert [got[k].n_near > 0 for k in range(5)] == [False, True, True, False, False]
    assert [got[k].n_hit for k in range(5)] == [26, 0, 0, 0, 0]
    assert all(tuple(got[k])[:6] == tuple(exact[k]) for k in exact) and len(got) == len(exact) == 5


@pytest.mark.parametrize("more", [{"block_pairs": 3}, {"block_pairs": 3, "max_terms": 0}, {"max_terms": 0}])
def test_one_index_serves_all_blocks(spark, more, monkeypatch):
    built, build = [], d.build_index
    monkeypatch.setattr(d, "build_index", lambda *a, **b: built.append(1) or build(*a, **b))
    texts = [f"start {' '.join(f'w{k * 7 + j}' for j in range(20))} end" for k in range(12)] + [None, ""]
    items = spark.createDataFrame([(k, " ".join(f"w{k * 14 + j}" for j in range(15))) for k in range(6)] + [(9, "end")], "item_id long, text string")
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "items", "contaminated", "n_near", "near_items").collect()))
    want = rows(d.contamination(frame(spark, texts), items, slop=2))
    built.clear()
    assert rows(d.contamination(frame(spark, texts), items, slop=2, **more)) == want
    assert len(built) == 1


def test_dropping_keeps_any_columns(spark):
    line = " ".join(f"w{j}" for j in range(13))
    items = spark.createDataFrame([(1, line)], "item_id long, text string")
    df = frame(spark, [line, "clean", None, ""]).selectExpr("*", "doc_id as _bad_id", "text as bad_row", "1 as _bad_row", "2 as BAD_KEY")
    out = d.drop_contaminated(df, items)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 3]
    assert d.drop_contaminated(df, items.limit(0)).count() == 4
    assert d.drop_contaminated(df.limit(0), items).count() == 0
