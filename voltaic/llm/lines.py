"""Lines that repeat across documents, found by two Bloom filters.

1. Tasks hash the distinct line keys of every document to places of a filter and note the places
   met once and those of keys met twice within the task, per segment of the filter.
2. Per segment, the notes of all tasks run together: a place met again moves to the second filter.
   A key of two documents has all its places there; other keys rarely have.
3. The second filter goes to all tasks (its size is bounded, see MAX_FILTER_BITS).  Only keys with
   all places in it are suspects; their 128-bit digests are shuffled and counted exactly, with
   partial counts first, so that a very common line is one row per task.
4. Documents drop the lines of keys found often enough, or all but the first occurrence.

Keys are told apart by 128-bit digests: among 10^12 different lines the chance that any two agree
is about 10^-15.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import stage
from .common import arrow_schema, ddl, record_batch, texts

#: Filter bits for each line of the input, places of a key, bits of a segment.
BITS_PER_LINE, PLACES, SEGMENT_BITS = 8, 2, 1 << 20
#: Bits of a filter at most (128 MB).  Inputs with more lines than LEAST_BITS can tell apart in it
#: use no filter: every key is a suspect then, and the result is the same.
MAX_FILTER_BITS, LEAST_BITS = 1 << 30, 1
#: Hashes that a task holds before it notes their places.
FLUSH = 1 << 21
#: Repeated keys that are sent to all tasks at most (16 bytes each, about 100 MB as a Python set);
#: more are joined instead.
MAX_SENT = 1 << 20

_KEY = {"a": "long", "b": "long"}
_PLACED = {"doc_id": "long", "text_key": "long", "a": "long", "b": "long", "line": "int"}
_NOTE = {"segment": "int", "once": "binary", "twice": "binary"}
_OUT = {"doc_id": "long", "n_lines": "long", "n_dropped": "long", "text": "string"}


def keys(text: bytes | None) -> list[bytes]:
    """Every line's key: A-Z lower-cased, without ASCII white space at both ends."""
    return [x.strip() for x in text.lower().split(b"\n")] if text else [b""]


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode()) >= least)


def digests(text: bytes | None, least: int) -> list[bytes | None]:
    """Digest of every line's key; None where the key has under ``least`` code points."""
    return [xxhash.xxh3_128_digest(k) if _long_enough(k, least) else None for k in keys(text)]


def _halves(found) -> np.ndarray:
    return np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)


def _key_rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"))


def _notes(halves: np.ndarray, segments: int, width: int):
    """Rows (segment, places met once or more, places of keys met twice), as sorted uint32."""
    _, at, count = np.unique(halves[:, 0], return_index=True, return_counts=True)
    whole = halves[at]
    bits = np.uint64(segments * width)
    once, twice = np.unique(whole % bits), np.unique(whole[count > 1] % bits)
    parts = []
    for places in (once, twice):
        ends = np.searchsorted(places, np.arange(segments + 1, dtype=np.uint64) * np.uint64(width))
        local = (places % np.uint64(width)).astype(np.uint32)
        parts.append([local[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])])
    rows = [(s, o, t) for s, (o, t) in enumerate(zip(*parts)) if o]
    return record_batch(_NOTE, dict(zip(_NOTE, map(list, zip(*rows))))) if rows else None


def seen_twice(rows: DataFrame, segments: int, least: int, width: int = SEGMENT_BITS, flush: int = FLUSH) -> np.ndarray:
    """The second filter as bytes, of ``segments`` of ``width`` bits (a multiple of 8): all places
    of every key that two documents hold are set."""
    def note(batches):
        held, size = [], 0
        for b in batches:
            for t in texts(b):
                found = set(digests(t, least)) - {None}
                held.extend(found)
                size += len(found)
            if size >= flush:
                if (out := _notes(_halves(held), segments, width)) is not None:
                    yield out
                held, size = [], 0
        if held and (out := _notes(_halves(held), segments, width)) is not None:
            yield out

    def merge(batches):  # rows come sorted by segment; one segment's filters are in memory
        now, once, twice = None, None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())], ["segment", "bits"])
        for b in batches:
            for s, o, t in zip(*(b.column(k).to_pylist() for k in _NOTE)):
                if s != now:
                    if now is not None:
                        yield done()
                    now, once, twice = s, np.zeros(width, bool), np.zeros(width, bool)
                o = np.frombuffer(o, np.uint32)
                twice[o[once[o]]] = True
                twice[np.frombuffer(t, np.uint32)] = True
                once[o] = True
        if now is not None:
            yield done()

    merged = (rows.select("text").mapInArrow(note, ddl(_NOTE))
              .repartition(F.col("segment")).sortWithinPartitions("segment").mapInArrow(merge, "segment int, bits binary"))
    out = np.zeros(segments * width // 8, np.uint8)
    step = width // 8
    for r in merged.collect():  # at most MAX_FILTER_BITS
        out[r["segment"] * step:(r["segment"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return out


def _suspected(halves: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
    if bits is None or not len(halves):
        return np.ones(len(halves), bool)
    places = halves % np.uint64(8 * len(bits))
    return ((bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(1)


def suspects(rows: DataFrame, bits, least: int, placed: bool) -> DataFrame:
    """One row per document row and suspected key: its digest (a, b); with ``placed`` also doc_id,
    text_key and the first line that has it.  ``bits`` broadcasts the second filter, or is None."""
    spec = _PLACED if placed else _KEY

    def run(batches):
        table = None if bits is None else bits.value
        for b in batches:
            found, lines, sizes = [], [], []
            for t in texts(b):
                first: dict[bytes, int] = {}
                for n, d in enumerate(digests(t, least)):
                    if d is not None:
                        first.setdefault(d, n)
                found.extend(first)
                lines.extend(first.values())
                sizes.append(len(first))
            halves = _halves(found)
            kept = np.flatnonzero(_suspected(halves, table))
            both = halves[kept].view(np.int64)
            columns = {"a": both[:, 0], "b": both[:, 1]}
            if placed:
                of = pa.array(np.repeat(np.arange(b.num_rows), sizes)[kept])
                columns |= {"line": np.array(lines, np.int32)[kept], "doc_id": b.column("doc_id").take(of), "text_key": b.column("text_key").take(of)}
            yield pa.RecordBatch.from_arrays([pa.array(columns[k]) for k in spec], schema=arrow_schema(spec))

    return (rows if placed else rows.select("text")).mapInArrow(run, ddl(spec))


def _repeated(rows: DataFrame, bits, min_docs: int, least: int, first: bool) -> DataFrame:
    """Keys of at least ``min_docs`` document rows: a, b, and with ``first`` also where the first
    occurrence is, by doc_id (null last), text hash and line."""
    counts = [F.count(F.lit(1)).alias("n_docs")]
    if first:
        counts.append(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "line")).alias("first"))
    found = suspects(rows, bits, least, first).groupBy("a", "b").agg(*counts).where(F.col("n_docs") >= min_docs)
    return found.select("a", "b", *(["first.doc_id", "first.text_key", "first.line"] if first else []))


def _drop_sent(rows: DataFrame, repeated: DataFrame, least: int, first: bool) -> DataFrame:
    sent = {np.array([r["a"], r["b"]], np.int64).tobytes(): ((r["doc_id"], r["text_key"], r["line"]) if first else None) for r in repeated.collect()}
    sent = rows.sparkSession.sparkContext.broadcast(sent)

    def run(batches):
        drop = sent.value
        for b in batches:
            out = {k: [] for k in _OUT}
            out["doc_id"] = b.column("doc_id").to_pylist()
            for i, k, t in zip(out["doc_id"], b.column("text_key").to_pylist(), texts(b)):
                found = digests(t, least)
                own = (t or b"").split(b"\n")
                if first:
                    kept = [x for n, (x, d) in enumerate(zip(own, found)) if d not in drop or drop[d] == (i, k, n)]
                else:
                    kept = [x for x, d in zip(own, found) if d not in drop]
                out["n_lines"].append(len(own))
                out["n_dropped"].append(len(own) - len(kept))
                out["text"].append(b"\n".join(kept).decode())
            yield record_batch(_OUT, out)

    return rows.mapInArrow(run, ddl(_OUT))


def _drop_joined(rows: DataFrame, repeated: DataFrame, bits, least: int, first: bool) -> DataFrame:
    """The same without sending the keys: each document row gets its own keys by a join."""
    held = stage(suspects(rows, bits, least, True).distinct(), "lines-suspects")
    named = repeated.select("a", "b", *([F.struct("doc_id", "text_key", "line").alias("first")] if first else []))
    met = held.join(named, ["a", "b"])
    own = F.struct("a", "b", *([F.when(F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key")),
                                       F.col("first.line")).alias("stays")] if first else [F.lit(None).cast("int").alias("stays")]))
    lists = met.groupBy(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")).agg(F.collect_list(own).alias("drop"))
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")

    def run(batches):
        for b in batches:
            out = {k: [] for k in _OUT}
            out["doc_id"] = b.column("doc_id").to_pylist()
            for t, own in zip(texts(b), b.column("drop").to_pylist()):
                drop = {np.array([x["a"], x["b"]], np.int64).tobytes(): x["stays"] for x in own or ()}
                lines = (t or b"").split(b"\n")
                kept = [x for n, (x, d) in enumerate(zip(lines, digests(t, least))) if d not in drop or drop[d] == n]
                out["n_lines"].append(len(lines))
                out["n_dropped"].append(len(lines) - len(kept))
                out["text"].append(b"\n".join(kept).decode())
            yield record_batch(_OUT, out)

    return joined.select("doc_id", "text", "drop").mapInArrow(run, ddl(_OUT))


def drop_repeated(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none",
                  max_filter_bits: int = MAX_FILTER_BITS, max_sent: int = MAX_SENT, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """One row per document: doc_id, n_lines (before dropping), n_dropped, text (what is left).

    Lines end at \\n.  A line's key is the line without ASCII white space at both ends, A-Z
    lower-cased.  Keys of at least ``min_chars`` code points that at least ``min_docs`` (2 or
    more) document rows hold lose all their lines (``keep="none"``) or all but their first
    occurrence (``keep="first"``: by doc_id, null last, then text hash and line; rows repeated in
    id and text keep it alike).  A key that one document repeats counts once for it.  Null and
    empty texts are one empty line, whose key is never long enough with ``min_chars`` of 1 or more.
    Every row counts as a document, repeated ones too.  Empty tables give empty results; other
    columns are not read.
    """
    if min_docs < 2 or min_chars < 1 or keep not in ("none", "first"):
        raise ValueError("min_docs must be 2 or more, min_chars 1 or more, keep 'none' or 'first'")
    rows, first = _key_rows(docs), keep == "first"
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = rows.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    bits = None
    if lines * LEAST_BITS <= max_filter_bits:
        segments = -(-min(lines * BITS_PER_LINE, max_filter_bits) // segment_bits)
        bits = rows.sparkSession.sparkContext.broadcast(seen_twice(rows, max(1, segments), min_chars, segment_bits))
    repeated = stage(_repeated(rows, bits, min_docs, min_chars, first), "lines-repeated")
    if repeated.count() <= max_sent:
        return _drop_sent(rows, repeated, min_chars, first)
    return _drop_joined(rows, repeated, bits, min_chars, first)
