"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings.

All steps are column expressions.  Places come from splitting a text at a pattern: the pieces
and the matches alternate, so their lengths add up to every match's start.  The entropy of a
window moves on by one character with two updates of the character counts and of the sum of
c log c, so a candidate is read once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is long enough matches as a whole, so the least lengths can be in the pattern.
_ACCESS = r"AKIA[A-Z0-9]{16,}"
_HEX = r"[0-9a-f]{24,}"
#: A candidate, and its parts between = and /.
#: Stands for characters that other spans have taken; in a text it counts as a line end.
_MARK = "\ue000"
_WHOLE = rf"[A-Za-z0-9+/_={_MARK}-]{{20,}}"
_PART = rf"[A-Za-z0-9+_{_MARK}-]{{20,}}"

#: Characters of a window.
WINDOW = 20
#: Character class of a candidate: what it consists of and the least entropy of a window in bits.
#: Windows of 20 random characters have about 3.0 bits (digits), 3.3 (hex digits) and 4.1 (letters).
CLASSES = ((r"^[0-9]+$", 3.0), (r"^[0-9a-fA-F]+$", 3.0), (r"^[A-Za-z]+$", 4.05), (r"^[A-Za-z0-9]+$", 3.7), (r"", 3.9))
#: Candidates that are no secrets: those that begin or end as placeholders or runs of the alphabet do,
#: UUIDs, lower-case words between separators.
_FILLER = r"example|sample|dummy|placeholder|changeme|your[_-]|x{6,}|abcdefgh|01234567|12345678"
ALLOWED = (rf"(?i)^(?:{_FILLER})|(?:{_FILLER}|90123456|34567890)$|^[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}$"
           r"|(?-i)^[a-z/_-]*[/_-][a-z/_-]*$")

_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Counters of five bits each, so many to a 64-bit word.
_PER_WORD = 12
#: Matches whose places are summed up in one go.
_CHUNK = 128


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def max_entropy(text: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of any ``window`` consecutive characters of ``text``;
    0 for shorter ones.  Characters are those of _SYMBOLS."""
    term = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    words = -(-(len(_SYMBOLS) + 1) // _PER_WORD)
    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), words).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    # The number of each character's symbol, once; a step then reads two of them by their place.
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(_SYMBOLS), c))

    def scan(codes: Column) -> Column:
        word = lambda c: F.floor(c / _PER_WORD).cast("int")
        one = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), (5 * (c % _PER_WORD)).cast("int"))
        count = lambda n, c: F.call_function("shiftright", F.get(n, word(c)), (5 * (c % _PER_WORD)).cast("int")).bitwiseAND(F.lit(31)).cast("int")

        def step(state: Column, k: Column) -> Column:
            # "came" enters; "went" leaves once the window is full (0: nothing does)
            came, went = F.get(codes, k - 1), F.when(k > window, F.get(codes, k - window - 1)).otherwise(F.lit(0))
            n_in, n_out = count(state["n"], came), count(state["n"], went)
            counts = F.transform(state["n"], lambda c, j: c + F.when(j == word(came), one(came)).otherwise(F.lit(0).cast("long"))
                                 - F.when((j == word(went)) & (went > 0), one(went)).otherwise(F.lit(0).cast("long")))
            changed = F.when(came == went, F.lit(0.0)).otherwise(
                F.get(term, n_in + 1) - F.get(term, n_in)
                + F.when(went > 0, F.get(term, n_out - 1) - F.get(term, n_out)).otherwise(F.lit(0.0)))
            total = state["sum"] + changed
            return F.struct(counts.alias("n"), total.alias("sum"),
                            F.when(k >= window, F.greatest(state["best"], F.lit(math.log2(window)) - total / window))
                            .otherwise(state["best"]).alias("best"))

        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), zero, step, lambda s: s["best"])

    return F.when(F.length(text) >= window, once(codes, scan)).otherwise(F.lit(0.0))


def is_random(text: Column) -> Column:
    """Whether a candidate's best window reaches its class's entropy and no allow-list entry fits."""
    def reached(best: Column) -> Column:
        out = F.lit(False)
        for pattern, least in reversed(CLASSES):
            out = F.when(text.rlike(pattern), best >= least).otherwise(out)
        return out

    return ~text.rlike(ALLOWED) & once(max_entropy(text), reached)


def places(kind: str, text: str, found: str, pattern: str) -> Column:
    """Structs (start, kind number, end, match) of the matches in column ``found``."""
    pieces = F.split(F.col(text), pattern, -1)
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,match:string>>)")
    lengths = F.zip_with(F.slice(pieces, 1, F.size(found)), F.col(found),
                         lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("own"), m.alias("match")))

    def spans(part: Column, at: Column) -> Column:
        """Spans of a few matches, the first of which follows ``at``."""
        return F.aggregate(part, F.struct(at.alias("at"), none.alias("out")), lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["own"]).alias("at"),
            F.concat(s["out"], F.array(F.struct((s["at"] + x["gap"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                (s["at"] + x["gap"] + x["own"]).alias("end"), x["match"].alias("match")))).alias("out")),
            lambda s: s["out"])

    # Appending copies a list, so lists stay short: where each chunk of matches starts, then the places in it.
    def chunked(lengths: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int"))
        chunks = F.transform(numbers, lambda c: F.slice(lengths, c * _CHUNK + 1, F.lit(_CHUNK)))

        def placed(chunks: Column) -> Column:
            totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x["gap"] + x["own"]))
            starts = F.aggregate(totals, F.array(F.lit(0)), lambda s, n: F.concat(s, F.array(F.element_at(s, -1) + n)))
            return F.flatten(F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), spans))
        return once(chunks, placed)

    return F.when(F.size(found) > 0, once(lengths, chunked)).otherwise(none)


def masked(text: str, found: str, pattern: str, gone: Column) -> Column:
    """Column ``text`` with _MARK for every character of the matches that ``gone`` (booleans) names."""
    pieces = F.split(F.col(text), pattern, -1)
    matches = F.zip_with(F.col(found), gone, lambda m, g: F.when(g, F.repeat(F.lit(_MARK), F.length(m))).otherwise(m))
    return F.when(F.size(found) > 0, F.array_join(F.zip_with(pieces, matches, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")).otherwise(F.col(text))


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base and more: arrays of (start, kind, end), by start,
    then kind as numbered in KINDS; code points, end exclusive.

    base holds the fixed patterns' spans; more holds strings of 20 characters and more that
    touch none of them and have a window of high entropy for their character class: parts between = and
    /, and whole candidates without such a part.  Left out are allow-listed parts (ALLOWED), shorter
    strings, and letters or digits of less spread.  A string is read once, whatever its length.  Null and empty texts have none.  Repeated rows give repeated rows, an empty
    table none; a null doc_id stays null; other columns are not read.
    """
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _MARK, "\n")
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    patterns = {"assign": _ASSIGN, "access": _ACCESS, "hex": _HEX}
    all_of = lambda text, p: F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0))
    for kind, p in patterns.items():
        df = df.withColumn(f"_{kind}", all_of("text", p))
    for kind, p in patterns.items():
        df = df.withColumn(f"at_{kind}", places(kind, "text", f"_{kind}", p))
    span = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    # A value too short drops the match; there is no second try within it.
    whole_value = lambda m: F.length(F.regexp_extract(m, _ASSIGN, 2)) >= 6
    assigns = F.filter("at_assign", lambda x: whole_value(x["match"]))
    df = df.select("doc_id", F.array_sort(F.transform(F.concat(assigns, "at_access", "at_hex"), span)).alias("base"),
                   masked("text", "_assign", _ASSIGN, F.transform("_assign", whole_value)).alias("text"))
    # What touches a base span is one run with its marks.  Of a span that another one has marked in
    # part the rest is next to those marks.
    for p in (_HEX, _ACCESS):
        df = df.withColumn("found", all_of("text", p))
        df = df.withColumn("text", masked("text", "found", p, F.transform("found", lambda m: F.lit(True))))
    for name, p in (("parts", _PART), ("wholes", _WHOLE)):
        df = df.withColumn("found", all_of("text", p))
        # A whole without / and = is its own part.
        left = "[/=]" if name == "wholes" else ""
        df = df.withColumn("random", F.transform("found", lambda m: ~m.contains(_MARK) & m.rlike(left) & is_random(m)))  # noqa: B023
        at = F.zip_with(places("entropy", "text", "found", p), F.col("random"), lambda x, r: F.struct(span(x).alias("x"), r.alias("r")))
        df = df.withColumn(name, F.transform(F.filter(at, lambda x: x["r"]), lambda x: x["x"]))
        df = df.withColumn("text", masked("text", "found", p, F.col("random")))
    return df.select("doc_id", "base", F.array_sort(F.concat("parts", "wholes")).alias("more"))
