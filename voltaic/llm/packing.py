"""Best-fit packing of token sequences by patterns fitted with non-negative least squares.

1. Every text becomes token ids and an end id; longer ones are cut into pieces.  Only a
   piece's place, length and checksum move on, never its tokens.
2. The histogram of piece lengths (at most one count for every length up to the capacity) is
   packed on the driver, in counts: patterns of a few length classes that fill a sequence are
   fitted to the histogram by non-negative least squares; rounded repeat counts are realised
   with exact lengths; what is left over packs best-fit into the gaps, longest first.  The
   cost depends on the number of distinct lengths, not of documents.
3. Every piece gets its rank among the pieces of its length from per-task counters and a
   running sum over tasks, and looks up its sequence and offset in the plan.
"""

from __future__ import annotations

import bisect
import functools
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stage import stage
from .common import arrow_schema, ddl, record_batch, texts

CAPACITY = 4096
END_ID = 1
#: Width of a length class as a share of the capacity, and documents of a pattern.
CLASSES, DEPTH = 64, 4
#: Word forms that a worker remembers, about 150 MB: the half met last and the half before it.
REMEMBERED = 750_000

_PIECE = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long",
          "part": "int", "nth": "long"}
_PACKED = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long",
           "sequence_id": "long", "offset": "long"}


class Encoder:
    """Token ids of whole texts as packed little-endian 32-bit numbers.

    The vocabulary's pre-tokenizer parts a text at white space and between letters, digits
    and other characters, so word forms can be encoded once and remembered.  That holds for
    texts of ASCII and simple Latin letters; any other text goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.form = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[a-z\x80-\xff]+|[0-9]|[^\sa-z0-9\x80-\xff]+")
        self.ascii = bytes(range(128))
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.simple: dict[str, bool] = {}

    def _is_simple(self, c: str) -> bool:
        got = self.simple.get(c)
        if got is None:
            low = c.lower()
            got = self.simple[c] = (c < "ɐ" and c.isalpha() and len(low) == 1 and low.isalpha()
                                    and unicodedata.is_normalized("NFC", c))
        return got

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, forms: list[bytes]) -> None:
        for lo in range(0, len(forms), 2_000):
            part = forms[lo:lo + 2_000]
            joined = b" ".join(part).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(cuts) == len(part):
                packed = ids.tobytes()
                self.known.update(zip(part, map(packed.__getitem__, map(slice, [0, *cuts[:-1]], cuts))))
            else:  # a form that is not one word for the tokenizer
                for f in part:
                    self.known[f] = self._whole(f.decode())

    def ids(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        other = text.translate(None, self.ascii)
        if (other and not all(map(self._is_simple, set(other.decode())))) or any(a in text for a in self.added):
            return self._whole(text.decode())
        forms = self.form.findall(text.lower())
        if len(self.known) > REMEMBERED // 2:  # forms that are met again come back from there
            self.known, self.earlier = {}, self.known
        new = set(forms).difference(self.known)
        if new:
            earlier, fresh = self.earlier, []
            for f in new:
                if f in earlier:
                    self.known[f] = earlier[f]
                else:
                    fresh.append(f)
            self._learn(fresh)
        return b"".join(map(self.known.__getitem__, forms))


class SharedEncoder:
    """One encoder for each Python worker, so what it remembers serves all the worker's tasks of a query.

    To be sent as a broadcast value: Spark takes that from a worker with the first task that does not
    use it, so what was remembered takes no memory from the stages that follow."""

    def __init__(self, path: str):
        self.path = path

    @functools.cached_property
    def own(self) -> Encoder:
        return Encoder(self.path)

    def __reduce__(self):
        return SharedEncoder, (self.path,)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Staged rows of doc_id, piece, start, length, ids_crc32, and part and nth: the task and
    the rank among the task's pieces of that length."""
    end = np.array([end_id], "<u4").tobytes()
    sent = docs.sparkSession.sparkContext.broadcast(SharedEncoder(tokenizer_path))

    def run(batches):
        own_encoder, seen, part = sent.value.own, Counter(), TaskContext.get().partitionId()
        for b in batches:
            cols: dict[str, list] = {k: [] for k in _PIECE}
            for doc, t in zip(b.column("doc_id").to_pylist(), texts(b)):
                ids = own_encoder.ids(t) + end
                for k, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[lo:lo + 4 * capacity]
                    n = len(own) // 4
                    for name, v in zip(_PIECE, (doc, k, lo // 4, n, zlib.crc32(own), part, seen[n])):
                        cols[name].append(v)
                    seen[n] += 1
            yield record_batch(_PIECE, cols)

    return stage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ddl(_PIECE)), "pieces")


def patterns(classes: int, depth: int) -> list[tuple[int, ...]]:
    """Class multisets, largest first, of at most ``depth`` classes that add up to ``classes``."""
    out = []

    def grow(head: tuple[int, ...], left: int):
        if not left:
            out.append(head)
        elif len(head) < depth:
            for c in range(min(left, head[-1] if head else left), 0, -1):
                grow((*head, c), left - c)
    grow((), classes)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 500) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[free] = 0
        k = int(gain.argmax())
        if gain[k] <= 1e-10:
            break
        free[k] = True
        while True:
            idx = np.flatnonzero(free)
            s = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[idx] = s
                break
            bad = s <= 0
            step = (x[idx][bad] / np.maximum(x[idx][bad] - s[bad], 1e-300)).min()
            x[idx] += step * (s - x[idx])
            free &= x > 1e-12
            x[~free] = 0
            if not free.any():
                break
    return x


class Bins:
    """Open sequences by the room they have: equal ones are kept as one counted group.

    A group's content is a run-length tuple ((length, times), ...).
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: dict[int, list[list]] = {}
        self.rooms: list[int] = []

    def put(self, room: int, content: tuple, count: int) -> None:
        if not count:
            return
        if room not in self.groups:
            self.groups[room] = []
            bisect.insort(self.rooms, room)
        self.groups[room].append([content, count])

    def take(self, least: int):
        """(room, content, count) of a group with the least room that is enough, or None."""
        k = bisect.bisect_left(self.rooms, least)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        content, count = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room]
            self.rooms.pop(k)
        return room, content, count

    def best_fit(self, length: int, count: int) -> None:
        """Pack ``count`` pieces of one length: the fullest sequence that takes one, filled up
        before the next is opened."""
        while count:
            room, content, n = self.take(length) or (self.capacity, (), -(-count // (self.capacity // length)))
            per = room // length
            full = min(n, count // per)
            self.put(room - full_len(per, length), (*content, (length, per)), full)
            count -= full * per
            n -= full
            if n and count:  # the last one takes what is left
                part = min(count, per)
                self.put(room - full_len(part, length), (*content, (length, part)), 1)
                count -= part
                n -= 1
            if content:
                self.put(room, content, n)


def full_len(times: int, length: int) -> int:
    return times * length


def pack(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES, depth: int = DEPTH) -> list[tuple[tuple, int]]:
    """(content, repeats) of all sequences for a histogram of lengths."""
    unit = -(-capacity // classes)
    left = {n: c for n, c in histogram.items() if c > 0}
    bins = Bins(capacity)
    kind = lambda n: min(classes, max(1, round(n / unit)))
    demand = np.zeros(classes)
    for n, c in left.items():
        demand[kind(n) - 1] += c
    total = demand.sum()
    if not total:
        return []
    known = [p for p in patterns(classes, depth) if all(demand[c - 1] for c in p)]
    if known:
        a = np.zeros((classes, len(known)))
        for k, p in enumerate(known):
            for c in p:
                a[c - 1, k] += 1
        weight = np.where(np.arange(1, classes + 1) * 8 >= classes, 1.0, 0.1)  # short ones fill gaps as well
        repeats = np.floor(nnls(a * weight[:, None], weight * demand / total) * total + 1e-9).astype(np.int64)
        by_class: dict[int, list[int]] = {}
        for n in sorted(left):
            by_class.setdefault(kind(n), []).append(n)
        for k in np.argsort(-repeats, kind="stable"):
            if repeats[k]:
                _realise(known[k], int(repeats[k]), by_class, left, bins, capacity)
    for n in sorted(left, reverse=True):
        bins.best_fit(n, left[n])
    return [(content, count) for groups in bins.groups.values() for content, count in groups]


def _realise(pattern, repeats: int, by_class, left: dict[int, int], bins: Bins, capacity: int) -> None:
    """Fill up to ``repeats`` sequences by a pattern, with the longest exact lengths that fit."""
    work = [(capacity, (), repeats)]
    for c in pattern:
        after = []
        for room, content, count in work:
            fitting = by_class.get(c, ())
            k = bisect.bisect_right(fitting, room) - 1
            while count and k >= 0:
                n = fitting[k]
                take = min(count, left.get(n, 0))
                if take:
                    after.append((room - n, (*content, (n, 1)), take))
                    left[n] -= take
                    count -= take
                if not left.get(n):
                    left.pop(n, None)
                    fitting.pop(k)
                k -= 1
            if content:
                bins.put(room, content, count)
        work = after
    for room, content, count in work:
        bins.put(room, content, count)


def slots(packed: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """The plan as arrays: pieces of ``length`` with ranks from ``rank`` on lie ``per`` to a
    sequence, from sequence ``sequence`` and place ``offset`` on."""
    rows, used, first = [], Counter(), 0
    for content, count in packed:
        at = 0
        for length, per in content:
            rows.append((length, used[length], first, at, per))
            used[length] += count * per
            at += length * per
        first += count
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "offset", "per"), cols))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts have the end id alone.  Only documents longer than ``capacity`` are
    cut.  Repeated rows are packed each for itself; a null doc_id stays null.  An empty table
    gives no rows.  Other columns are not read.
    """
    rows = pieces(docs, tokenizer_path, capacity, end_id)
    each = stage(rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    plan = docs.sparkSession.sparkContext.broadcast(slots(pack(histogram, capacity)))
    # A window holds one row for every task that met the length.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.join(base.hint("merge"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def run(batches):
        p = plan.value
        key = p["length"] << 44 | p["rank"]
        for b in batches:
            length, rank = (b.column(k).to_numpy() for k in ("length", "rank"))
            k = np.searchsorted(key, length << 44 | rank, "right") - 1
            j = rank - p["rank"][k]
            seq, off = p["sequence"][k] + j // p["per"][k], p["offset"][k] + j % p["per"][k] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                                              pa.array(seq), pa.array(off)], schema=arrow_schema(_PACKED))

    return ranked.mapInArrow(run, ddl(_PACKED))
