import random
import re

import pytest

from voltaic.llm import licenses as x

from .helpers import extra, frame


def brute(t):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    hits = sorted((k, label) for p, label in x.BASE_PHRASES.items() for q in [p.split()] for k in range(len(w)) if w[k:k + len(q)] == q)
    starts = [k for k, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), sorted({n for _, n in hits})


def test_base_is_the_definition():
    r = random.Random(2)
    vocab = ["gnu", "GNU", "general", "public", "license", "Apache", "CC", "by", "mit", "MIT", "é", "cc-by", "license,", "x"]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += ["CC BY CC BY", "mit license mit license apache license", "gnu general public license " * 40 + "cc by", "", None, "MIT\nLicense é mit—license"]
    assert sum(brute(t)[1] for t in texts) > 100
    for t in texts:
        assert x.scan(None if t is None else t.encode())[:5] == brute(t)


@pytest.mark.parametrize("line,postfix", [
    (" MIT", "MIT"), (" MIT OR Apache-2.0 AND BSD-3-Clause", "MIT Apache-2.0 BSD-3-Clause and or"),
    ("(MIT or Apache-2.0) and GPL-2.0-only with Classpath-exception-2.0", "MIT Apache-2.0 or GPL-2.0-only Classpath-exception-2.0 with and"),
    (" MIT */ and so on", "MIT"), (" MIT see file", "MIT"), (" MIT)", "MIT"), (" (MIT", None), (" OR MIT", None), (" MIT AND", None), ("", None),
    (" ((A))", "A"), (" ()", None), ("A with B or C", "A B with C or"), (" Apache-2.0.", "Apache-2.0"),
])
def test_expressions(line, postfix):
    got = x.parse(line)
    assert (None if got is None else " ".join(got)) == postfix


def test_evaluation():
    p = x.parse("(MIT OR GPL-3.0-only) AND BSD-3-Clause")
    assert x.licences(p) == ["bsd", "gpl", "mit"] and x.permitted(p)
    assert not x.permitted(x.parse("GPL-2.0+ WITH Classpath-exception-2.0"))
    assert x.licences(x.parse("GPL-2.0+ WITH Classpath-exception-2.0 or Odd-1.0")) == ["gpl", "odd-1.0"]
    assert not x.permitted(x.parse("MIT AND LGPL-2.1"))


def test_rows(spark):
    texts = ["// SPDX-License-Identifier: MIT OR GPL-2.0-only\ncode", "SPDX-License-Identifier: (MIT", "the BSD License", None, "", "x " * 100_000 + "cc by"]
    rows = {r.doc_id: r for r in x.find(extra(spark, texts)).collect()}
    assert rows[0].labels == ["gpl", "mit"] and rows[0].permissive and rows[0].base_labels == [] and rows[0].score == 0.95
    assert rows[1].labels == [] and rows[1].permissive is None and 0 < rows[1].score < 0.5
    assert rows[2].labels == ["bsd"] and rows[3].n_words == 0 and rows[4].score == 0
    assert rows[5].first_word == rows[5].last_word == 100_000
    assert x.find(extra(spark, ["a", "a"], ids=[1, 1])).count() == 2 and x.find(frame(spark, ["a"]).limit(0)).count() == 0
