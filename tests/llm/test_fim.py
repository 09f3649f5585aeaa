"""Fill-in-middle: cuts against slices of the text, exact round trips, edge cases."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltaic.llm import fim

from .helpers import DOCS, extra, frame


def brute(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    text, n = text or "", len(text or "")
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(1, 9))
def test_cuts_of_code_points(text, block):
    tree = fim.BlockTree(text.encode(), None, block)
    assert tree.n_units == tree.n_points == len(text)
    for k in range(len(text) + 1):
        assert tree.cut(k) == (len(text[:k].encode()), k)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é漢\n", max_size=60), st.integers(1, 9))
def test_cuts_of_pattern_units(text, block):
    unit = re.compile(rb"[^\x20\n]+")
    ends = [0] + [m.end() for m in unit.finditer(text.encode())]
    tree = fim.BlockTree(text.encode(), unit, block)
    assert tree.n_units == len(ends) - 1
    for k, e in enumerate(ends):
        assert tree.cut(k) == (e, len(text.encode()[:e].decode()))


def test_a_unit_over_many_blocks():
    text = b"x" * 10_000 + b" y"
    assert fim.BlockTree(text, re.compile(rb"\S+"), 16).cut(1) == (10_000, 10_000)


def test_a_long_text_is_cut_locally():
    rng = random.Random(5)
    text = "".join(rng.choice("aé漢😀") for _ in range(400_000))
    tree = fim.BlockTree(text.encode())
    for k in (1, 399_999, 400_000, *(rng.randrange(400_000) for _ in range(50))):
        assert tree.cut(k) == (len(text[:k].encode()), k)


TEXTS = ["", None, "a", "plain words é 漢字 😀", "has <P> in it", "<S>", "x<M", "ends with <S", "P>S>M>", "<", "\n\n", "🇨🇭" * 500, "a" * 100_000]


def test_against_slices_and_round_trip(spark):
    rng = random.Random(7)
    texts = TEXTS * 5 + ["".join(rng.choice("<PSM> é") for _ in range(rng.randrange(40))) for _ in range(200)]
    done = fim.transform(frame(spark, texts)).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert len(done) == len(texts)
    for r in done:
        t = texts[r["doc_id"]]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], t)
        assert r["back"] == (t or "")
    assert {r["form"] for r in done} == {"plain", "psm", "spm"}


def test_edges(spark):
    rows = spark.createDataFrame([(None, "some text", "", "", 1), (3, "same", "", "", 1), (3, "same", "", "", 1)], DOCS)
    got = sorted(((r["doc_id"], r["output"]) for r in fim.transform(rows).collect()), key=str)
    assert got == sorted([(None, brute(None, "some text")[4])] + 2 * [(3, brute(3, "same")[4])], key=str)
    assert fim.transform(rows.limit(0)).count() == 0
    assert fim.transform(extra(spark, ["abc"])).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


@pytest.mark.parametrize("share", [0, 100])
def test_shares(spark, share):
    done = fim.transform(frame(spark, ["some text"] * 50), cut_share=share, spm_share=share).collect()
    assert {r["form"] for r in done} == ({"spm"} if share else {"plain"})
