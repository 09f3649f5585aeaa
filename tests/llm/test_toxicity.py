import math
import random
import zlib

import numpy as np

from voltaic.llm import toxicity as x

from .helpers import extra, frame

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900, seed=4):
    r = random.Random(seed)
    vocab = ["w%d" % k for k in range(300)]
    bad = ["vilebeast", "oafish", "snarkling"]
    texts, toxic = [], []
    for k in range(n):
        ws = [r.choice(vocab) for _ in range(r.randint(5, 60))]
        toxic.append(int(r.random() < .2))
        if toxic[-1]:
            for _ in range(r.randint(1, 4)):
                ws.insert(r.randrange(len(ws)), r.choice(bad) + (r.choice(["", "er", "en"]) if r.random() < .5 else ""))
        texts.append(" ".join(ws))
    return texts, toxic


def test_held_out_accuracy(spark):
    texts, toxic = corpus()
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)], LABELS)
    rows = x.score(extra(spark, texts), labels).collect()
    assert len(rows) == len(texts)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 4 == 2}
    wrong = [r.doc_id for r in held if r.predicted != toxic[r.doc_id]]
    assert len(wrong) <= 0.02 * len(held), wrong
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    kept = x.drop_toxic(extra(spark, texts), labels)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if not r.predicted)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    texts, toxic = corpus(300)
    rows = [(k, 1, t) for k, t in enumerate(toxic)]
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 4 == 2 else t) for k, q, t in rows]
    a, b = ({r.doc_id: r.score for r in x.score(frame(spark, texts), spark.createDataFrame(y, LABELS)).collect()} for y in (rows, flipped))
    assert a == b


def test_index_is_exact():
    r = random.Random(7)
    idf = np.array([r.uniform(.5, 5) for _ in range(30)])
    vecs = {tuple(sorted(r.sample(range(30), r.randint(1, 6)))) for _ in range(400)}
    protos = [(v, tuple(r.randint(1, 5) for _ in v), 1, 1, k) for k, v in enumerate(sorted(vecs))] + [((), (), 0, 9, -1)]
    index = x.BlockMaxIndex(protos, idf, block=8)

    def dense(t, c):
        v = np.zeros(30)
        v[list(t)] = [(1 + math.log(q)) * idf[k] for k, q in zip(t, c)]
        return v / (np.linalg.norm(v) or 1)
    every = np.array([dense(*p[:2]) for p in index.protos])
    for t, c, *_ in protos[::7]:
        sims, near = index.nearest(t, c, 15)
        if not t:
            assert near.tolist() == [index.zero]
            continue
        want = np.round(every @ dense(t, c), 12)
        want = want[want > 0]
        cut = np.sort(want)[::-1][min(15, len(want)) - 1]
        assert len(near) == (want >= cut - 1e-10).sum()
        assert np.allclose(sims, np.sort(want[want >= cut - 1e-10])[::-1])


def test_isotonic_never_falls():
    xs, ys = x.isotonic([0, .2, .2, .5, .9], [0, 1, 0, 0, 1], [5, 1, 1, 1, 3])
    assert xs == sorted(xs) and ys == sorted(ys)


def test_edges_of_input(spark):
    none = spark.createDataFrame([], LABELS)
    df = extra(spark, ["a", "a", None, "", "word " * 50_000], ids=[1, 1, None, 2, 3])
    rows = x.score(df, none).collect()
    assert len(rows) == 5 and all(r.score == 0 and r.predicted == 0 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 7), (3, 1, 0), (3, 1, 1)], LABELS)
    assert x.score(df, odd).count() == 5
    assert x.score(df.limit(0), odd).count() == 0
    assert x.drop_toxic(df, none).columns == df.columns and x.drop_toxic(df, none).count() == 5


def test_whole_index_is_exact():
    """Against dense cosines of all words, words that no example has included."""
    from voltaic.llm import whole_texts as w
    r = random.Random(3)
    draw = lambda: {b"w%d" % min(int(r.paretovariate(.6)), 400): r.randint(1, 4) for _ in range(r.randint(0, 40))}
    texts = [draw() for _ in range(300)]
    texts += [{k: n for k, n in t.items() if r.random() < .9} for t in texts[:100]] + texts[:5]
    found = {}
    for t in texts:
        for k in t:
            found[k] = found.get(k, 0) + 1
    weights = w.Weights(found, 1000)
    every = [weights.vector(t) for t in texts]
    index = w.WholeTexts(every, len(found), block=16)

    def dense(v):
        out = np.zeros(len(found))
        out[v[0]] = v[1]
        return out
    matrix = np.array([dense(v) for v in every])
    n = 0
    for k, t in enumerate(texts[:60] + [draw() | {b"unseen": 2} for _ in range(60)]):
        v = weights.vector(t)
        assert sum(x * x for x in v[1]) <= 1 + 1e-9 and (b"unseen" not in t or sum(x * x for x in v[1]) < 1)
        want = matrix @ dense(v)
        for floor in (.3, .6, .95):
            got, sims = index.near(*v, floor)
            assert set(np.flatnonzero(want >= floor + 2e-6)) <= set(got.tolist()) <= set(np.flatnonzero(want >= floor - 2e-6))
            assert np.allclose(sims, want[got], atol=2e-6)
            n += len(got)
        assert k not in index.near(*every[k], .3, without=k)[0].tolist()
    assert n > 300


def test_rare_words_of_an_example_tell(spark):
    """A toxic example of five words that nothing else has, and texts near and far from it."""
    texts, toxic = corpus(500)
    rare = "qarzul mibbet dronkel vuspar hexlim"
    at = next(k for k in range(500, 600) if zlib.crc32(str(k).encode()) % 4 != 2)
    more = {at: rare, 9001: rare, 9002: rare + " " + texts[0].split()[0], 9003: texts[0], 9004: "qarzul " + texts[0]}
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)] + [(at, 1, 1)], LABELS)
    rows = {r.doc_id: r for r in x.score(frame(spark, texts + list(more.values()), ids=[*range(500), *more]), labels).collect()}
    assert rows[at].predicted == rows[9001].predicted == rows[9002].predicted == 1
    assert rows[9001].evidence[0] == at and rows[9001].similarity[0] == 1
    assert rows[9003].score == rows[0].score and rows[9004].predicted == rows[0].predicted


def test_score_is_the_votes_of_dense_cosines(spark):
    """The whole-text side of every score, from dense vectors over all words."""
    texts, toxic = corpus(260, seed=8)
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)], LABELS)
    df = frame(spark, texts + texts[:40] + [t + " extra" for t in texts[40:80]])
    model = x.fit(df, labels)
    all_texts = [r.text for r in df.orderBy("doc_id").collect()]
    words = sorted({w for t in all_texts for w in t.split()})
    spot = {w: k for k, w in enumerate(words)}
    has = np.zeros(len(words))
    known = {w for i in model.ids for w in texts[i].split()}
    for t in all_texts:
        has[[spot[w] for w in set(t.split())]] += 1
    idf = np.array([math.log(1 + len(all_texts) / (1 + (has[k] if w in known else 1))) for k, w in enumerate(words)])

    def dense(t):
        v = np.zeros(len(words))
        for w in set(t.split()):
            v[spot[w]] = (1 + math.log(t.split().count(w))) * idf[spot[w]]
        return v / (np.linalg.norm(v) or 1)
    matrix = np.array([dense(texts[i]) for i in model.ids])
    numbers = {k.encode("latin-1"): n for n, k in enumerate(model.terms)}
    scorer, near = x.Scorer(model), 0
    for t in all_texts[200:]:
        counts = x.whole_texts.counted(t.encode())
        got = x._picked(counts, numbers)
        telling = model.unit(tuple(sorted(got)), tuple(got[k] for k in sorted(got)))
        same = [sum(telling.get(k, 0) * v for k, v in o.items()) if telling or o else 1.0 for o in model.own]
        sims = matrix @ dense(t) * np.array(same)
        votes = np.flatnonzero(sims >= x.NEAR)
        p = model.index.vote(tuple(sorted(got)), tuple(got[k] for k in sorted(got)))[0]
        if len(votes):
            near += 1
            w = model.counts[votes] / (1.05 - sims[votes])
            share = ((sims.max() - x.NEAR) / (1 - x.NEAR)) ** 2
            p = (1 - share) * p + share * (w * model.labels[votes]).sum() / w.sum()
        assert math.isclose(scorer(t.encode())[0], min(1, max(0, np.interp(p, *model.knots))), abs_tol=1e-3)
    assert near > 60


def test_only_words_that_begin_like_a_term_are_looked_up():
    """And the terms found are those of the definition, short words and words of few bytes beyond ASCII included."""
    class Counted(dict):
        asked = 0

        def get(self, *a):
            self.asked += 1
            return super().get(*a)
    r = random.Random(5)
    draw = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 9))).encode()
    for _ in range(200):
        counts = {draw(): r.randint(1, 5) for _ in range(60)}
        names = r.sample(sorted(x._terms(counts)), 8) + [draw() for _ in range(3)]
        ids = {k: n for n, k in enumerate(dict.fromkeys(names))}
        every = x._terms(counts)
        assert x._picked(counts, ids) == {n: every[k] for k, n in ids.items() if k in every}
    ids = Counted({b"vile": 0, b"oafi*": 1, b"oaf": 2})
    counts = {b"plain%d" % k: 1 for k in range(500)} | {b"vile": 2, b"oafish": 3, b"oaf": 1}
    assert x._picked(counts, ids) == {0: 2, 1: 3, 2: 1}
    assert ids.asked <= 15


def test_long_lists_are_read_only_if_many_examples_are_left(monkeypatch):
    from voltaic.llm import whole_texts as w
    r = random.Random(11)
    common = [b"c%d" % k for k in range(60)]

    def near(texts, queries):
        found = {k: sum(k in t for t in texts) for k in {k for t in texts for k in t}}
        weights = w.Weights(found, len(texts))
        every = [weights.vector(t) for t in texts]
        index = w.WholeTexts(every, len(found), block=16)
        matrix = np.zeros((len(texts), len(found)))
        for k, v in enumerate(every):
            matrix[k, v[0]] = v[1]
        read = lists = 0
        plain = w.WholeTexts._lists

        def spied(first, ids):
            nonlocal read
            out = plain(first, ids)
            read += len(out[0]) if first is index.first else 0
            return out
        monkeypatch.setattr(w.WholeTexts, "_lists", staticmethod(spied))
        for t in queries:
            ids, own = weights.vector(t)
            want = matrix[:, ids] @ own
            got, sims = index.near(ids, own, .6)
            assert set(np.flatnonzero(want >= .6 + 2e-6)) <= set(got.tolist()) <= set(np.flatnonzero(want >= .6 - 2e-6))
            assert np.allclose(sims, want[got], atol=2e-6)
            order = np.argsort(-own, kind="stable")
            rest = np.sqrt(np.append(np.cumsum(own[order][::-1] ** 2)[::-1], 0))
            cut = ids[order][:int(np.argmax(rest < .4 * .6))]  # until the rest is short
            lists += int((index.first[cut + 1] - index.first[cut]).sum())
        monkeypatch.undo()
        return read, lists

    # Texts of rare and common words: the rare ones leave few examples.
    mixed = [{**{b"r%d" % r.randrange(2000): 1 for _ in range(12)}, **{k: 1 for k in r.sample(common, 30)}} for _ in range(400)]
    read, lists = near(mixed, mixed[:80])
    assert 0 < read < .5 * lists
    # Texts alike in all: many examples are left, and the further lists sort them out.
    alike = [{k: r.randint(1, 3) for k in r.sample(common, 40)} for _ in range(400)]
    read, lists = near(alike, alike[:80])
    assert 0 < read <= lists
