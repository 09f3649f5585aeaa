"""run() against a brute-force version on small tables, nulls and copies included."""

import random

import pytest

import corpus_pipeline
from voltaic.llm import pii

from .test_decontaminate import brute as brute_hits
from .test_packing import check, plain_ids
from .test_simhash import brute_components, brute_fp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long"


def tables(spark, folder, seed=11):
    r = random.Random(seed)
    vocab = ["w%d" % k for k in range(400)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(k, say(r.choice([5, 14, 30]))) for k in range(12)]
    texts, toxic = [], []
    for k in range(700):
        t = say(r.randint(1, 120))
        toxic.append(int(r.random() < .15))
        if toxic[-1]:
            t += " " + " ".join(r.choice(["grubnik", "slimeball", "dreckzeug"]) for _ in range(3))
        elif r.random() < .1:
            t += " " + r.choice(items)[1]
        elif r.random() < .1:
            t += " mail bob%d@mail.example.com or +1 858 555 2128" % k
        texts.append(t)
    for k in range(0, 60, 2):
        texts.append(texts[k].replace("w7 ", "w8 ", 1) if k % 4 else texts[k])
        toxic.append(toxic[k])
    texts += [None, "", None, "  "]
    rows = [(k, t, "en", "s", len(t or ""), .5, 1) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, y) for k, y in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(enumerate(texts)), {k for k, y in enumerate(toxic) if y}, items


def brute(texts, toxic, items):
    left = {k: t for k, t in texts.items() if k not in toxic}
    ids = list(left)
    roots = brute_components([brute_fp(left[k]) for k in ids], 4)
    first = {}
    for k, root in zip(ids, roots):
        first[root] = min(first.get(root, k), k)
    left = {k: left[k] for k in first.values()}
    left = {k: t for k, t in left.items() if not brute_hits(t, items)[3]}
    return {k: None if t is None else pii.redact_text(t) for k, t in left.items()}


def test_run_matches_brute_force(spark, tmp_path):
    texts, toxic, items = tables(spark, str(tmp_path))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(texts, toxic, items)
    assert 100 < len(want) < len(texts) - len(toxic) - 40
    n = check(rows, want)
    assert n <= -(-sum(len(plain_ids(t or "")) // 4 + 1 for t in want.values()) // 4096) + 1


def test_stages_keep_columns_and_bear_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs.limit(0), str(tmp_path))
        assert out.count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


@pytest.mark.parametrize("part", ["documents", "labels", "benchmark"])
def test_run_on_an_empty_table(spark, tmp_path, part):
    tables(spark, str(tmp_path))
    empty = spark.read.parquet(f"{tmp_path}/{part}.parquet").limit(0)
    empty.write.mode("overwrite").parquet(f"{tmp_path}/empty.parquet")
    import os
    os.rename(f"{tmp_path}/{part}.parquet", f"{tmp_path}/was-{part}.parquet")
    os.rename(f"{tmp_path}/empty.parquet", f"{tmp_path}/{part}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).count()
    assert (rows == 0) == (part == "documents")
