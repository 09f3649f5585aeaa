"""Licence scan: Aho-Corasick for notice phrases and identifier tags, and a shunting-yard
parser for licence expressions with and, or, with and brackets."""

from __future__ import annotations

import functools
import re

import ahocorasick
from pyspark.sql import DataFrame

from .common import map_rows, words

#: Phrases of whole words and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further phrases of the method.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd", "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd", "boost software license": "bsl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0",
}
TAG = "spdx license identifier"
#: First parts of identifiers and the family they belong to, longest first.
FAMILIES = ("cc-by", "cc0", "lgpl", "agpl", "gpl", "apache", "mit", "bsd", "mpl", "epl", "isc", "bsl")
PERMISSIVE = frozenset({"apache", "mit", "bsd", "isc", "cc-by", "cc0", "bsl"})
#: Weight of one piece of evidence: a base phrase, a further phrase, a well-formed tag, a broken one.
WEIGHTS = {"base": 0.8, "more": 0.6, "tag": 0.95, "broken": 0.3}

_TOKEN = re.compile(r"[ \t]*(?:([()])|(?i:(and|or|with))(?![A-Za-z0-9.+:-])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_TAG_AT = re.compile(r"spdx-license-identifier[ \t]*:", re.I | re.A)
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse(line: str) -> list[str] | None:
    """The expression at the start of ``line`` in postfix order, or None if there is none.

    Reads as far as a well-formed expression goes: an operand that follows an operand, or a
    bracket without its partner, ends it.
    """
    out, stack, at, operand, depth = [], [], 0, False, 0
    while m := _TOKEN.match(line, at):
        bracket, op, ident = m.groups()
        if ident:
            if operand:
                break
            out.append(ident.rstrip(".:"))
            operand = True
        elif op:
            if not operand:
                return None
            op = op.lower()
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[op]:
                out.append(stack.pop())
            stack.append(op)
            operand = False
        elif bracket == "(":
            if operand:
                break
            stack.append("(")
            depth += 1
        else:
            if not operand:
                return None
            if not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        at = m.end()
    if not operand or depth:
        return None
    return out + stack[::-1]


def family(ident: str) -> str:
    low = ident.lower()
    return next((f for f in FAMILIES if low == f or low.startswith((f + "-", f + "+"))), low)


def licences(postfix: list[str]) -> list[str]:
    """Families of the licences in an expression; what follows with is an exception, not a licence."""
    out, stack = set(), []
    for x in postfix:
        if x in _BINDS:
            right, left = stack.pop(), stack.pop()
            stack.append(left if x == "with" else left | right)
        else:
            stack.append({family(x)})
    for s in stack:
        out |= s
    return sorted(out)


def permitted(postfix: list[str], allowed: frozenset[str] = PERMISSIVE) -> bool:
    """Whether some choice under the expression needs allowed families only."""
    stack: list[bool] = []
    for x in postfix:
        if x in _BINDS:
            right, left = stack.pop(), stack.pop()
            stack.append(left if x == "with" else left and right if x == "and" else left or right)
        else:
            stack.append(family(x) in allowed)
    return stack[0]


@functools.lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("more", MORE_PHRASES), ("tag", {TAG: ""})):
        for p, label in phrases.items():
            found.add_word(f" {p} ", (kind, p, label))
    found.make_automaton()
    return found


def scan(text: bytes | None) -> tuple:
    """n_words, n_base, first_word, last_word, base labels, labels, expressions, permissive, score."""
    ws = words(text)
    line = f" {b' '.join(ws).decode()} "
    n_base, first, last, word, seen = 0, None, None, 0, 0
    base, labels, kinds, tagged = set(), set(), {}, False
    for end, (kind, phrase, label) in _automaton().iter(line):
        if kind == "tag":
            tagged = True
            continue
        start = end - len(phrase) - 1
        if kind == "base":
            # hits come by their ends, so starts may step back by a phrase's length at most
            word += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
            seen = start
            first, last = word if first is None else min(first, word), word if last is None else max(last, word)
            n_base += 1
            base.add(label)
        labels.add(label)
        kinds[phrase] = WEIGHTS[kind]
    expressions, permissive = [], None
    if tagged:
        raw = text.decode()
        for m in _TAG_AT.finditer(raw):
            stop = raw.find("\n", m.end())
            postfix = parse(raw[m.end():stop if stop >= 0 else len(raw)])
            kinds[m.start()] = WEIGHTS["broken" if postfix is None else "tag"]
            if postfix is not None:
                expressions.append(" ".join(postfix))
                labels.update(licences(postfix))
                permissive = permitted(postfix) and permissive is not False
    left = 1.0
    for w in kinds.values():
        left *= 1 - w
    return (len(ws), n_base, first, last, sorted(base), sorted(labels), expressions, permissive, round(1 - left, 12))


_FOUND = {"doc_id": "long", "n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long",
          "base_labels": "array<string>", "labels": "array<string>", "expressions": "array<string>",
          "permissive": "boolean", "score": "double"}


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, expressions (postfix), permissive, score.

    score is 1 less the product of (1 - weight) over the distinct phrases and the tags found.
    permissive tells whether every tag's expression can be met with permissive licences, null
    without tags.  Null and empty texts: no words, nulls, empty lists, score 0.  Repeated rows
    give repeated rows, an empty table none; a null doc_id stays null; other columns are not
    read.
    """
    return map_rows(docs, _FOUND, lambda: scan)
