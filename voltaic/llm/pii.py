"""Personal data with offset-preserving deobfuscation.

Identifiers are detected in the text as it stands and in a normalised form.  The normal form
is made by transducers that carry, for every character they emit, the span of source
characters it came from: homoglyphs and full-width forms, invisible characters, spelled
digits, and at/dot disguises.  Spans found in the normal form are mapped back to the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from copy import copy

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, texts

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits matches from its start or not at all, so later starts need no look.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Letters of other scripts that look like ASCII ones.
_LOOKALIKES = dict(zip("АВЕКМНОРСТУХаеіјорсухѕԁԛԝαονικρτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEKMHOPCTYXaeijopcyxsdqwaovikptABEZHIKMNOPTYX"))
_INVISIBLE = frozenset("​‌‍⁠﻿­")
#: Spelled digits.
_DIGITS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
           "eight": "8", "nine": "9", "oh": "0", "null": "0"}
_SPELLED = "|".join(_DIGITS)
#: Spelled digits and groups of digits in a row; every start lies behind the run before it.
_ITEM = rf"(?:{_SPELLED}|[0-9]++)(?![A-Za-z0-9])"
_SPELLED_RUN = re.compile(rf"(?<![A-Za-z0-9]){_ITEM}(?:[ ,.-]{{1,2}}{_ITEM})*+", re.I | re.A)
_SPELLED_ONE = re.compile(rf"({_SPELLED})|([0-9]+)|[ ,.-]+", re.I | re.A)
_PLUS = re.compile(r"(?<![A-Za-z])plus *(?=[0-9])", re.I | re.A)
_AT = re.compile(r"(?<=[A-Za-z0-9]) ?[\[({<] ?(?:at|@) ?[\])}>] ?(?=[A-Za-z0-9])", re.I | re.A)
_DOT = re.compile(r"(?<=[A-Za-z0-9]) ?[\[({<] ?(?:dot|\.) ?[\])}>] ?(?=[A-Za-z0-9])", re.I | re.A)
_NUMBER_DOT = re.compile(r"(?<=[0-9]) dot (?=[0-9])", re.I | re.A)
#: What may follow a local part: an at and a domain, whose dots may be bare words.
_BARE = re.compile(r"(?:(?<=[A-Za-z0-9._%+-])@|(?<=[A-Za-z0-9]) (?:at|@) )([A-Za-z0-9-]++(?:(?:\.| dot )[A-Za-z0-9-]++)+)", re.I | re.A)
_LABEL = re.compile(r"(\.| dot |^)([A-Za-z0-9-]+)", re.I | re.A)
_TOP_LABEL = re.compile(r"[A-Za-z]{2,24}|xn--[A-Za-z0-9-]+", re.A)
#: Words of running text.  Those that begin no domain after a bare at, those that
#: are no top-level label after a bare dot, and those that are no local part before a bare at.
_NO_DOMAIN = frozenset("the a an this that these those each every any some all his her its their our my your which what www".split())
_NO_TOP = frozenset("the and or of on if we he she they up that this these those for with from which when where who was were are but not".split())
_NO_LOCAL = frozenset("is are was were be been and or but it them him her us not only here there".split())
#: What tells an address with a bare "at" from running text: a request to write right before it,
#: a name that is written like one, or a bare dot before a label that ends addresses.  Fixed values: the
#: generic labels, and the two-letter ones that are English words and so tell nothing.
_ASKED = re.compile(r"(?:^|[^A-Za-z])(?:(?:e-?)?mails?|mailto|contacts?|write|writes|reach|ask|address|send)(?: (?:to|is|me|us|him|her|them))?[ :]+$", re.I | re.A)
_LIKE_LOCAL = re.compile(r"[A-Za-z][A-Za-z0-9-]*[._+%][A-Za-z]|[A-Za-z]{2}[0-9]{2,}$", re.A)
_TOPS = frozenset("com org net edu gov mil int info biz name pro museum app dev xyz online site".split())
_TWO_LETTER_WORDS = frozenset("am an as at be by do go he hi if in is it me my no of oh ok on or so to up us we".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(t: str):
    free, at = 0, t.find("@")
    while at >= 0:
        lo = at
        while lo > free and t[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(t, at + 1) if lo < at else None
        if m:
            yield lo, m.end()
            free = m.end()
        at = t.find("@", max(at + 1, free))


def _ips(t: str):
    for m in _IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(t: str):
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(t: str):
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield m.span()


def identifiers(t: str, kinds: tuple[int, ...] = tuple(range(len(KINDS)))) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of identifiers in plain sight, by start, then kind."""
    return sorted((a, k, b) for k, find in enumerate((_emails, _ips, _cards, _phones)) if k in kinds for a, b in find(t))


class Rewritten:
    """A text with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put strings in place of (from, to) stretches, given in order; every character put
        stands for the whole stretch."""
        if not edits:
            return
        text, start, end, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            start += [self.start[at:a], np.full(len(new), self.start[a])]
            end += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.start = np.concatenate([*start, self.start[at:]])
        self.end = np.concatenate([*end, self.end[at:]])


def _plain(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    got = _LOOKALIKES.get(c)
    if got is None and not c.isascii():
        wide = unicodedata.normalize("NFKC", c)
        digit = unicodedata.decimal(c, None)
        got = str(digit) if digit is not None else wide if len(wide) == 1 and wide.isascii() and "＀" <= c <= "￯" else c
    return c if got is None else got


def _addresses(t: str) -> list[tuple[int, int, str]]:
    """Edits that write out e-mail addresses with bare words or spaces for at and dots."""
    edits, free = [], 0
    for m in _BARE.finditer(t):
        at, lo = m[0][:m.start(1) - m.start()], m.start()
        bare, labels = at != "@", [(x, m.start(1)) for x in _LABEL.finditer(m[1])]
        keep = 1
        while keep < len(labels) and (labels[keep][0][1] == "." or labels[keep][0][2].lower() not in _NO_TOP):
            keep += 1
        if bare or any(x[1] not in ("", ".") for x, _ in labels[:keep]):
            while keep > 1 and not _TOP_LABEL.fullmatch(labels[keep - 1][0][2]):
                keep -= 1
        if keep < 2:
            continue
        words, end = [x[2] for x, _ in labels[:keep]], m.start(1) + labels[keep - 1][0].end()
        dots = [(x.start(1) + o, x.end(1) + o, ".") for x, o in labels[1:keep] if x[1] != "."]
        first, left = lo, []
        while first > free and t[first - 1] in _LOCAL:
            first -= 1
        if bare:
            if words[0].lower() in _NO_DOMAIN or t[first:lo].lower() in _NO_LOCAL or t[end:end + 1] == "/":
                continue
            if not dots and words[-1].istitle() and not words[-2].istitle():
                continue  # two sentences without a space between them
            top = words[-1].lower()
            ends = bool(dots) and (top in _TOPS or len(top) == 2 and top not in _TWO_LETTER_WORDS)
            if at.strip() != "@" and not (ends or _LIKE_LOCAL.search(t[first:lo]) or t[max(first - 5, free):first].lower() == " dot "
                                          or _ASKED.search(t[max(first - 24, 0):first])):
                continue
        while t[max(first - 5, free):first].lower() == " dot " and first - 6 >= free and t[first - 6] in _LOCAL:
            k = first - 5
            while k > free and t[k - 1] in _LOCAL:
                k -= 1
            if t[k:first - 5].lower() in _NO_DOMAIN:
                break
            left.append((first - 5, first, "."))
            first = k
        edits += [*left[::-1], *([(lo, m.start(1), "@")] if bare else []), *dots]
        free = end
    return edits


def _numbers(form: Rewritten, dots: bool) -> Rewritten:
    """Spelled digits as digits.  What stands between two spelled ones goes; so does, unless
    ``dots``, what stands between a spelled one and digits.  With ``dots`` a dot stays one."""
    edits = []
    for m in _SPELLED_RUN.finditer(form.text):
        parts = list(_SPELLED_ONE.finditer(m[0]))
        for k, x in enumerate(parts):
            span = (m.start() + x.start(), m.start() + x.end())
            if x[1]:
                edits.append((*span, _DIGITS[x[1].lower()]))
            elif not x[2]:
                spelled = bool(parts[k - 1][1]) + bool(parts[k + 1][1])
                if dots and "." in x[0]:
                    edits.append((*span, "."))
                elif spelled == 2 or spelled and not dots:
                    edits.append((*span, ""))
    if not edits:
        return form
    out = copy(form)
    out.replace(edits)
    return out


def normalise(t: str) -> list[tuple[Rewritten, tuple[int, ...]]]:
    """The normal forms of a text that differ from it, each with the kinds to look for in it.

    Spelled digits need two: a dot next to one parts the numbers of an address, but not the
    digit groups of a card or phone.  Which edits make an identifier is for its check to say.
    """
    out, plain = Rewritten(t), {}
    if not t.isascii():
        plain = {c: p for c in set(t) if not c.isascii() for p in (_plain(c),) if p != c}
        if plain:
            out.replace([(k, k + 1, plain[c]) for k, c in enumerate(t) if c in plain])
    if any(c in out.text for c in "[({<"):
        out.replace([(*m.span(), "@") for m in _AT.finditer(out.text)])
        out.replace([(*m.span(), ".") for m in _DOT.finditer(out.text)])
    out.replace(_addresses(out.text))
    low = out.text.lower()
    spelled = any(w in low for w in _DIGITS)
    groups, parted = (_numbers(out, False), _numbers(out, True)) if spelled else (out, out)
    if " dot " in low:
        parted = copy(parted)
        parted.replace([(*m.span(), ".") for m in _NUMBER_DOT.finditer(parted.text)])
    if "plus" in low:
        groups = copy(groups)
        groups.replace([(*m.span(), "+") for m in _PLUS.finditer(groups.text)])
    return [(form, kinds) for form, kinds in ((out, (0,)), (parted, (1,)), (groups, (2, 3))) if form.text != t]


def spans(t: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans in plain sight, and those that only the normal form shows, in source characters.

    A span of the normal form is left out if one of its kind in plain sight is equal to it or
    covers it; one that reaches further than a plain fragment of itself is returned besides it.
    """
    base = identifiers(t) if t else []
    more = []
    plain = {k: [(a, b) for a, kind, b in base if kind == k] for k in range(len(KINDS))}
    for form, kinds in normalise(t) if t else ():
        for a, kind, b in identifiers(form.text, kinds):
            s, e = int(form.start[a]), int(form.end[b - 1])
            at = bisect_right(plain[kind], (s, len(t))) - 1  # those of a kind are disjoint
            if at < 0 or plain[kind][at][1] < e:
                more.append((s, kind, e))
    return base, sorted(more)


def _named(found: list[tuple[int, int, int]]) -> list[str]:
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


_FOUND = {"doc_id": "long", "base": "array<string>", "more": "array<string>"}


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base and more: lists of kind:start:end by start, then
    kind, in code points, end exclusive.

    Null and empty texts have none.  Repeated rows give repeated rows, an empty table none;
    a null doc_id stays null; other columns are not read.
    """
    def make():
        def one(t):
            base, more = spans(t.decode() if t else None)
            return _named(base), _named(more)
        return one
    return map_rows(docs, _FOUND, make)


def redact_text(t: str) -> str:
    """The text with a [KIND] mark in place of every identifier; overlapping ones become one."""
    base, more = spans(t)
    out, at = [], 0
    for a, kind, b in sorted(base + more):
        if a >= at:
            out += [t[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, t[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, identifiers replaced by marks; n_chars, where there is
    such a column, follows the new text.  Null texts stay null."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("text")
            new = pa.array([None if t is None else redact_text(t.decode()) for t in texts(b)], b.schema.field(at).type)
            cols = list(b.columns)
            cols[at] = new
            k = b.schema.get_field_index("n_chars")
            if k >= 0 and pa.types.is_integer(b.schema.field(k).type):
                changed = pc.fill_null(pc.not_equal(new, b.column(at)), False)
                cols[k] = pc.if_else(changed, pc.cast(pc.utf8_length(new), b.schema.field(k).type), b.column(k))
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
