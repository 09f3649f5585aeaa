"""Fill-in-middle transformation of whole texts.

A text's UTF-8 bytes are cut into blocks of a fixed size.  A Fenwick tree over the blocks holds
how many units and how many code points end in each; a descent by powers of two finds the block
in which a cut falls, and only that block is searched for the boundary itself.  Units are code
points, or the matches of a pattern from left to right.

Which units are cut, and the form, come from a hash of the document's id, so that a task that
runs again gives the same rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ddl, record_batch, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, so many are cut; of 100 that are cut, so many put the suffix first.
CUT_SHARE, SPM_SHARE = 90, 20
#: Bytes of a block.
BLOCK = 4096

_ROW = {"doc_id": "long", "n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


class BlockTree:
    """Fenwick tree over the blocks of one text: units and code points that end in each.

    ``unit`` is None for code points, else a compiled bytes pattern; its matches must be whole
    code points and not empty.
    """

    def __init__(self, text: bytes, unit: re.Pattern | None = None, block: int = BLOCK):
        self.text, self.unit, self.block = text, unit, block
        data = np.frombuffer(text, np.uint8)
        starts = np.arange(0, len(data), block)
        points = np.add.reduceat(self._ends(data), starts, dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        if unit is None:
            units = points
        else:
            ends = np.fromiter((m.end() for m in unit.finditer(text)), np.int64)
            units = np.bincount((ends - 1) // block, minlength=len(starts))
            #: Where a search in a block goes on: the end of the last unit before it.
            last = np.searchsorted(ends, starts, "right") - 1
            self.resume = np.where(last >= 0, ends[last], 0) if len(ends) else np.zeros(len(starts), np.int64)
        self.n_units, self.n_points = int(units.sum()), int(points.sum())
        self.units, self.points = self._tree(units), self._tree(points)

    @staticmethod
    def _ends(data: np.ndarray) -> np.ndarray:
        """True at the last byte of every code point."""
        ends = np.ones(len(data), bool)
        ends[:-1] = (data[1:] & 0xC0) != 0x80
        return ends

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        """Node k (from 1) holds the sum of the ``k & -k`` counts up to the k-th."""
        sums, k = np.concatenate(([0], np.cumsum(counts))), np.arange(1, len(counts) + 1)
        return [0, *(sums[k] - sums[k - (k & -k)]).tolist()]

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points up to the end of unit ``k``; none for 0."""
        if k <= 0:
            return 0, 0
        m = len(self.units) - 1
        at, units, points = 0, 0, 0
        step = 1 << (m.bit_length() - 1)
        while step:  # the most blocks whose units are fewer than k
            if at + step <= m and units + self.units[at + step] < k:
                at += step
                units, points = units + self.units[at], points + self.points[at]
            step >>= 1
        lo = at * self.block
        data = np.frombuffer(self.text, np.uint8, count=min(self.block + 1, len(self.text) - lo), offset=lo)
        ends = self._ends(data)[:self.block]
        if self.unit is None:
            end = lo + int(np.flatnonzero(ends)[k - units - 1]) + 1
        else:
            found = self.unit.finditer(self.text, int(self.resume[at]))
            for _ in range(k - units):
                end = next(found).end()
        return end, points + int(ends[:end - lo].sum())


def split(doc_id: int | None, text: bytes, unit: re.Pattern | None = None, seed: int = 1, cut_share: int = CUT_SHARE,
          spm_share: int = SPM_SHARE, block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """n units, form, code points of prefix and middle, and the output of one text."""
    tree = BlockTree(text, unit, block)
    n = tree.n_units
    digest = hashlib.sha256(b"%d:%s" % (seed, b"" if doc_id is None else b"%d" % doc_id)).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[4 * k:4 * k + 4]) for k in range(4))
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if not text or p in text or s in text or m in text or h3 % 100 >= cut_share:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_points), (b, b_points) = tree.cut(a), tree.cut(b)
    if h4 % 100 < spm_share:
        return n, "spm", a_points, b_points - a_points, s + text[b:] + p + text[:a] + m + text[a:b]
    return n, "psm", a_points, b_points - a_points, p + text[:a] + s + text[b:] + m + text[a:b]


def transform(docs: DataFrame, unit: bytes | None = None, seed: int = 1, cut_share: int = CUT_SHARE,
              spm_share: int = SPM_SHARE, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output.

    Prefix and middle end after the smaller and the larger of two hashed numbers of units; what
    follows is the suffix.  Texts that are empty or hold a mark stay plain, and so do the
    documents beyond ``cut_share``; their prefix_chars and middle_chars are null.  A null text
    is empty.  The hash reads ``seed:doc_id``; a null doc_id stays null and hashes as no digits.
    Repeated rows give repeated rows, an empty table none; other columns are not read.  One
    text's blocks are in memory at a time, whatever its length.
    """
    def run(batches):
        pattern = None if unit is None else re.compile(unit)
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            rows = [split(i, t or b"", pattern, seed, cut_share, spm_share, block) for i, t in zip(ids, texts(b))]
            columns = dict(zip(list(_ROW)[1:], map(list, zip(*rows)))) if rows else {k: [] for k in list(_ROW)[1:]}
            columns["output"] = [x.decode() for x in columns["output"]]
            yield record_batch(_ROW, columns | {"doc_id": ids})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ddl(_ROW))


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.  A cut text holds no mark, and no mark can arise
    where a part meets one, so the three marks in the output are the three that were set."""
    after = lambda c, mark: F.substring(c, F.instr(c, mark) + len(mark), F.length(c))
    before = lambda c, mark: F.substring(c, F.lit(1), F.instr(c, mark) - 1)
    between = lambda first, then: before(after(output, first), then)
    psm = F.concat(between(PREFIX, SUFFIX), after(output, MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(output, MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
