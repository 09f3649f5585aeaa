import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from voltaic.llm import packing

from .helpers import extra, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def plain_ids(text):
    return np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


ODD = ["", "Hello, World! it's we'll 'sound' don't 12345 7.5%", "naïve Über straße ÉCOLE ñandú œuvre", "tab\tnew\nline\x0b\x0c\r end",
       "é combining Å. İstanbul İ. ...…“quotes”", "Привет мир ΣΑΣ Ὀδυσσεύς", "日本語 한국어 한",
       "x\x1cy\x85z\xa0w v", "<|endoftext|> a<|startoftext|>b", "'' ''' !'s !'t 's't", "a'S B'LL x'Re", "🙂👍🏽 ok½²", "\x00\x01 ctrl"]


@pytest.mark.parametrize("text", ODD)
def test_encoder_is_the_tokenizer(text):
    assert packing.Encoder(PATH).ids(text.encode()) == plain_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aAbzZ0 9'.,!-stredvml\n\té ßÖñŁ́İ½’<|>"), max_size=60))
def test_encoder_on_random_text(text):
    assert packing.Encoder(PATH).ids(text.encode()) == plain_ids(text)


def test_encoder_forgets_by_halves(monkeypatch):
    """Ids stay right while remembered forms move to the earlier half, come back and go."""
    monkeypatch.setattr(packing, "REMEMBERED", 8)
    own = packing.Encoder(PATH)
    for k in range(40):
        text = f"the word form{'abcdefgh'[k % 8]} {'xyzuvw'[k % 6]}ing, the don't {k}"
        assert own.ids(text.encode()) == plain_ids(text)
    assert own.earlier and len(own.earlier) < 30
    assert own.ids(None) == own.ids(b"") == b""


def check(rows, texts, capacity=4096):
    """Whole documents, right checksums, gapless sequences; returns the number of sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = plain_ids(texts[doc] or "") + np.array([1], "<u4").tobytes()
        own.sort(key=lambda r: r.piece)
        n = len(ids) // 4
        assert [r.piece for r in own] == list(range(-(-n // capacity)))
        for r in own:
            assert r.start == r.piece * capacity and r.length == min(capacity, n - r.start)
            assert r.ids_crc32 == zlib.crc32(ids[4 * r.start:4 * (r.start + r.length)])
    for own in by_seq.values():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at <= capacity
    return len(by_seq)


def test_round_trip(spark):
    r = random.Random(1)
    texts = {k: " ".join(r.choice(["word", "Satz", "x9", "lengthy"]) for _ in range(r.choice([0, 3, 50, 400, 5000]))) for k in range(60)}
    texts |= {100 + k: t for k, t in enumerate(ODD)} | {200: None}
    rows = packing.pack_documents(frame(spark, list(texts.values()), list(texts)), PATH).collect()
    n = check(rows, texts)
    assert n <= -(-sum(x.length for x in rows) // 4096) + 1


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=30))
def test_pack_is_exact_and_tight(hist):
    packed = packing.pack(hist, capacity=64, classes=16)
    used = defaultdict(int)
    for content, count in packed:
        assert count > 0 and sum(n * t for n, t in content) <= 64
        for n, t in content:
            used[n] += t * count
    assert dict(used) == hist
    plan = packing.slots(packed)
    assert len(plan["length"]) < 3000


def test_pack_quality_and_bounded_plan():
    r = np.random.default_rng(2)
    lengths = np.minimum(4096, np.maximum(1, r.lognormal(6.3, 1.1, 300_000).astype(int)))
    hist = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    packed = packing.pack(hist)
    assert sum(c for _, c in packed) <= 1.001 * lengths.sum() / 4096
    more = packing.pack({k: v * 1000 for k, v in hist.items()})
    assert len(packing.slots(more)["rank"]) < 4 * len(packing.slots(packed)["rank"])


def test_nnls():
    r = np.random.default_rng(3)
    a, x = r.random((20, 40)), np.zeros(40)
    x[[3, 17, 29]] = 1, 2, 3
    got = packing.nnls(a, a @ x)
    assert (got >= 0).all() and np.abs(a @ got - a @ x).max() < 1e-6
    b = r.normal(size=20) + 0.5
    got = packing.nnls(a, b)
    grad = a.T @ (b - a @ got)
    assert grad.max() < 1e-6 and (got > 0).any() and np.abs(grad[got > 0]).max() < 1e-6


def test_edges_of_input(spark):
    rows = packing.pack_documents(extra(spark, ["a b", "a b", None, ""], ids=[1, 1, None, 2]), PATH).collect()
    assert sorted(r.length for r in rows) == [1, 1, 3, 3] and len({r.sequence_id for r in rows}) == 1
    assert sorted(r.offset for r in rows)[0] == 0 and len({r.offset for r in rows}) == 4
    assert packing.pack_documents(frame(spark, ["a"]).limit(0), PATH).count() == 0
    long = packing.pack_documents(frame(spark, ["word " * 20_000]), PATH).collect()
    assert check(long, {0: "word " * 20_000}) == 5


def test_workers_of_later_stages_hold_no_encoder(spark):
    docs = spark.range(400).selectExpr("id doc_id", "concat('word', id, ' of a text') text").repartition(8)
    assert packing.pack_documents(docs, PATH).count() == 400

    def held(batches):
        import gc
        rows = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_pydict({"rows": [rows], "n": [sum(type(x).__name__ == "Encoder" for x in gc.get_objects())]})

    found = spark.range(400).repartition(8).mapInArrow(held, "rows long, n long").collect()
    assert sum(r["rows"] for r in found) == 400 and not any(r["n"] for r in found)
