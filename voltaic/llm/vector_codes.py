"""Compression of vectors into part codes, with codebooks fitted in whole numbers.

Vectors become integers, are cut into equal parts, and every part is replaced by the index of
the nearest entry of its position's codebook.  The nearest entry is found by memoised grid cells:

* a part falls into a cell of a coarse grid, laid over the codebook's range;
* an entry can be nearest to some point of the cell's box only if its least distance to the box is
  not above the smallest of all entries' greatest distances to it; the entries left are
  kept per cell, so each cell is worked out once per task and codebook;
* only those entries are compared with the part exactly, lower indexes first.

The grid changes how many distances are computed, never the result.  All arithmetic is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_broadcast
from ..operators.stage import stage
from .common import arrow_schema, ddl

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integer components beyond this saturate (the vectors' own components then exceed 2^32).
LARGEST = 1 << 40
#: Cells of a codebook's range, about; cells remembered per part, after which all are forgotten.
CELLS, MAX_CELLS = 4096, 16_384
#: Rows worked on together.
ROWS = 8192

_SUM = {"part": "int", "entry": "int", "place": "int", "total": "long"}
_CODE = {"vec_id": "long", "label": "long", "code": "string", "error": "long"}
_TOP = (1 << 63) - 1


def _whole(values: np.ndarray, *others: np.ndarray) -> bool:
    """True if squared distances between all of these fit into 64-bit integers."""
    most = max([int(np.abs(x).max()) for x in (values, *others) if x.size], default=0)
    return values.shape[-1] * (2 * most) ** 2 <= _TOP


class Cells:
    """Nearest entries of one codebook (entries x width, int64) by memoised grid cells."""

    def __init__(self, book: np.ndarray, cells: int = CELLS, most: int = MAX_CELLS):
        self.book, self.most = book, most
        width = book.shape[1]
        per_side = max(1, int(cells ** (1 / width) + 1e-9))
        self.low = book.min(0)
        self.side = (book.max(0) - self.low) // per_side + 1
        self.known: dict[bytes, int] = {}
        self.count = np.zeros(0, np.int64)
        self.entry = np.zeros((0, len(book)), np.int16)
        self.evaluated = 0

    def _candidates(self, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every cell, how many entries may be nearest in its box, and which, ascending."""
        counts, entries = [], []
        for lo in range(0, len(cell), 512):
            a = (cell[lo:lo + 512] * self.side + self.low)[:, None, :]
            b = a + self.side - 1  # the last whole number in the box
            if not _whole(a, b, self.book):
                a, b = a.astype(object), b.astype(object)
            least = (np.maximum(np.maximum(a - self.book, self.book - b), 0) ** 2).sum(2)
            most = (np.maximum(abs(self.book - a), abs(self.book - b)) ** 2).sum(2)
            may = (least <= most.min(1)[:, None]).astype(bool)
            counts.append(may.sum(1))
            entries.append(np.argsort(~may, axis=1, kind="stable").astype(np.int16))
        return np.concatenate(counts), np.concatenate(entries)

    def _rows_of(self, cell: np.ndarray) -> np.ndarray:
        """Row of the memo for every cell; cells not met before are worked out."""
        low = cell.min(0)
        spans = [int(x) for x in cell.max(0) - low + 1]
        packed = np.zeros(len(cell), np.int64)
        size = 1
        for x in spans:
            size *= x
        if size < 1 << 62:  # one number per cell, for these rows only
            for k, x in enumerate(spans):
                packed = packed * x + (cell[:, k] - low[k])
            _, at, back = np.unique(packed, return_index=True, return_inverse=True)
        else:
            _, at, back = np.unique(cell, axis=0, return_index=True, return_inverse=True)
        names = [c.tobytes() for c in cell[at]]
        new = [k for k, x in enumerate(names) if x not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known, self.count, self.entry = {}, self.count[:0], self.entry[:0]
            new = list(range(len(names)))
        if new:
            count, entry = self._candidates(cell[at[new]])
            base = len(self.count)
            self.known.update((names[k], base + n) for n, k in enumerate(new))
            self.count, self.entry = np.concatenate((self.count, count)), np.concatenate((self.entry, entry))
        return np.array([self.known[x] for x in names], np.int64)[back.ravel()]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower one of equals) and squared distance of each row."""
        row = self._rows_of((x - self.low) // self.side)
        order = np.argsort(-self.count[row], kind="stable")  # rows with many candidates first
        y, row = x[order], row[order]
        kind = np.int64 if _whole(x, self.book) else object
        y, book = y.astype(kind), self.book.astype(kind)
        best, dist = self.entry[row, 0].astype(np.int64), ((y - book[self.entry[row, 0]]) ** 2).sum(1)
        left = np.searchsorted(-self.count[row], -np.arange(self.count[row[0]] + 1), "left")
        self.evaluated += len(x)
        for k in range(1, int(self.count[row[0]])):
            n = left[k]  # rows with more than k candidates
            e = self.entry[row[:n], k]
            d = ((y[:n] - book[e]) ** 2).sum(1)
            nearer = (d < dist[:n]).astype(bool)
            best[:n][nearer], dist[:n][nearer] = e[nearer], d[nearer]
            self.evaluated += n
        code, out = np.empty(len(x), np.int64), np.empty(len(x), dist.dtype)
        code[order], out[order] = best, dist
        return code, out


def quantised(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, q (integers) of every whole vector, staged.

    Rows whose vector is null, or holds a null or non-finite component, go; so do those whose
    length is not the commonest one of the rest (of equals the longer), which must be a
    multiple of ``parts``.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    top = float(LARGEST)
    whole = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(top)), F.lit(-top))))
    rows = stage(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
                 .where(F.col("v").isNotNull() & fine).select("vec_id", "label", whole.alias("q")), "codes-vectors")
    lengths = rows.groupBy(F.size("q").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not lengths:
        return rows
    n = lengths[0]["n"]
    if n == 0 or n % parts:
        raise ValueError(f"vectors of {n} components cannot be cut into {parts} equal parts")
    return rows.where(F.size("q") == n)


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks (parts x entries x width) of the rows with the smallest vec_id, null last, then
    by their components; of fewer rows, all."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    return np.array([r["q"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)


def _matrices(batches, names, width):
    """Blocks of at most ROWS rows: the other columns as Arrow arrays, and rows x width."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            b = batch.slice(lo, ROWS)
            yield [b.column(k) for k in names], b.column("q").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)


def moved_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry at the floor of its parts' mean; entries without parts stay.

    Tasks add up in 64 bits what one block of rows gives, Spark adds up the rest; the driver sees
    one row per component of a codebook.
    """
    parts, entries, width = books.shape

    def run(batches):
        cells = [Cells(b) for b in books]
        total, count, held = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64), 0
        for _, q in _matrices(batches, (), parts * width):
            for p in range(parts):
                x = q[:, p * width:(p + 1) * width]
                code, _ = cells[p].nearest(x)
                count[p] += np.bincount(code, minlength=entries)
                for k in range(width):
                    np.add.at(total[p, :, k], code, x[:, k])
            held += len(q)
            if held > 1 << 20:  # sums of LARGEST still fit
                yield batch(total, count)
                total[:], count[:], held = 0, 0, 0
        if held:
            yield batch(total, count)

    def batch(total, count):
        both = np.concatenate((count[:, :, None], total), axis=2)  # place 0 counts
        p, e, k = np.indices(both.shape)
        met = np.broadcast_to(count[:, :, None] > 0, both.shape).ravel()
        columns = [x.ravel()[met] for x in (p.astype(np.int32), e.astype(np.int32), k.astype(np.int32), both)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow_schema(_SUM))

    sums = rows.select("q").mapInArrow(run, ddl(_SUM)).groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {(r["part"], r["entry"], r["place"]): int(r["total"]) for r in sums.collect()}
    out = books.copy()
    for (p, e, k), x in found.items():
        if k:
            out[p, e, k - 1] = x // found[p, e, 0]
    return out


def books_digest(books: np.ndarray) -> str:
    """Hex SHA-256 of all components by part, entry and place, with commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encoded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error (summed squared distances)."""
    parts, entries, width = books.shape
    digits = np.array([f"{k:02x}" for k in range(entries)])

    def run(batches):
        cells = [Cells(b) for b in books]
        for (ids, labels), q in _matrices(batches, ("vec_id", "label"), parts * width):
            codes, error = [], 0
            for p in range(parts):
                code, dist = cells[p].nearest(q[:, p * width:(p + 1) * width])
                codes.append(digits[code])
                error = error + (dist if dist.max() <= _TOP // parts else dist.astype(object))
            error = pa.array([min(int(x), _TOP) for x in error], pa.int64())
            code = pa.array(list(map("".join, zip(*codes))), pa.string())
            yield pa.RecordBatch.from_arrays([ids, labels, code, error], schema=arrow_schema(_CODE))

    return rows.select("vec_id", "label", "q").mapInArrow(run, ddl(_CODE))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error), one row per whole vector, and the codebooks.

    Components become floor(scale * x).  Codebooks start as the parts of the vectors with the
    smallest vec_ids and move ``rounds`` times to the floored means of their parts; then all
    parts get their codes.  ``error`` sums the squared distances, ``label_error`` the errors of
    one label, null labels together; sums beyond a long stay at the largest long.

    Vectors that are null or hold null or non-finite components are dropped, and so are those of
    another length than the commonest.  Repeated rows give repeated rows; a repeated vec_id is
    taken in the order of its vectors, a null one last.  An empty table, or one without a whole
    vector, gives no row and empty codebooks.  Other columns are not read.
    """
    rows = quantised(vectors, parts, scale)
    books = first_books(rows, parts, entries)
    if not books.size:
        empty = ", ".join(f"{k} {t}" for k, t in _CODE.items()) + ", label_error long"
        return vectors.sparkSession.createDataFrame([], empty), books
    for _ in range(rounds):
        books = moved_books(rows, books)
    coded = stage(encoded(rows, books), "codes-coded")
    by_label = stage(coded.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_TOP).cast("decimal(38,0)")).cast("long").alias("label_error")), "codes-labels")
    out = coded.join(sized_broadcast(by_label), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return out, books
