"""SimHash near-duplicates by tiled exact comparison.

1. A fingerprint per text (numpy bit sums over the XXH64 of all word shingles).
2. Equal fingerprints collapse to one node, so copies never meet in pairs.
3. Fingerprints are dealt to strips of equal population count, each strip to tiles of a
   bounded number of rows.  Two fingerprints within ``radius`` bits have population counts
   at most ``radius`` apart, so only tiles of strips that near are compared; the others are
   never brought together.
4. One task compares one pair of tiles: exclusive-or and bit counts over numpy blocks.
   Blocks are ordered by the population counts of the four 16-bit quarters, and a pair of
   blocks is skipped when the quarters differ by more than the radius in sum (a lower
   bound of the distance).  A task returns a spanning forest of its links, not the links.
5. Connected components by star contraction; every round is written to the shared folder.

Work grows with the square of the number of distinct fingerprints; the skips take off a
constant factor.  Nothing is sampled, capped or collected: the driver sees 65 strip counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.load import delete_path
from ..operators.stage import stage
from ..session import scratch_path
from .common import arrow_schema, free_name, map_rows, spaced_words

SHINGLE = 4
RADIUS = 4
#: Rows of a tile at most; a task holds two tiles of 8-byte fingerprints.
TILE_ROWS = 131_072
#: Share of all rows that a tile holds at most, so that there are many pairs of tiles of like
#: size even where the strips near 32 bits hold most rows; small inputs have no tiles below
#: LEAST_TILE_ROWS.
TILE_SHARE, LEAST_TILE_ROWS = 1 / 32, 512
#: Rows of a block within a tile.
BLOCK_ROWS = 256

_EDGE = {"u": "long", "v": "long"}


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the shingles of ``text``, repeats included.

    Fewer words than a shingle: the whole sequence is one shingle; no words: 0.
    """
    ws = spaced_words(text.lower() if text else None)
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    ends = ends[shingle - 1:].tolist()
    for lo in range(0, n, 16_384):
        part = np.array([digest(joined[a:b], 42) for a, b in
                         zip(starts[lo:lo + 16_384], ends[lo:lo + 16_384])], np.uint64)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def row_key():
    """Hash of the whole text (null as empty): tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, fp (signed 64-bit)."""
    def make():
        def one(t):
            fp = fingerprint(t, shingle)
            return (fp - 2**64 if fp >= 2**63 else fp,)
        return one
    return map_rows(docs.select("doc_id", row_key().alias("text_key"), "text"),
                    {"doc_id": "long", "text_key": "long", "fp": "long"}, make, keep=("doc_id", "text_key"))


def _roots(n: int, links) -> np.ndarray:
    """Smallest index of each index's component; ``links`` yields arrays (i, j)."""
    root = np.arange(n)
    for i, j in links:
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:  # point every index at its root
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _block_links(x: np.ndarray, y: np.ndarray | None, radius: int, block: int):
    """Arrays (i, j) of rows of x and y (or of x alone) at most ``radius`` bits apart."""
    def boxes(fps):
        q, starts = _quarters(fps), np.arange(0, len(fps), block)
        return np.minimum.reduceat(q, starts), np.maximum.reduceat(q, starts), starts

    lo_x, hi_x, sx = boxes(x)
    lo_y, hi_y, sy = (lo_x, hi_x, sx) if y is None else boxes(y)
    other = x if y is None else y
    for k, a in enumerate(sx):
        gap = np.maximum(0, np.maximum(lo_y - hi_x[k], lo_x[k] - hi_y)).sum(1)
        near = np.flatnonzero(gap <= radius)
        for m in near[near >= k] if y is None else near:
            b = sy[m]
            d = np.bitwise_count(x[a:a + block, None] ^ other[None, b:b + block])
            i, j = np.nonzero(d <= radius)
            if len(i):
                yield i + a, j + b


def compare_tiles(x: np.ndarray, y: np.ndarray | None, radius: int = RADIUS,
                  block: int = BLOCK_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (fingerprint, root) of the links between two tiles, or within one."""
    def ordered(fps):
        q = _quarters(fps)
        return fps[np.lexsort((fps, q[:, 3], q[:, 2], q[:, 1], q[:, 0]))]

    x = ordered(x)
    if y is None:
        both, links = x, _block_links(x, None, radius, block)
    else:
        y = ordered(y)
        n, both = len(x), np.concatenate((x, y))
        links = ((i, j + n) for i, j in _block_links(x, y, radius, block))
    root = _roots(len(both), links)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return both[moved], both[root[moved]]


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (u, v) that connect all fingerprints of ``nodes`` (column fp, distinct) at most
    ``radius`` bits apart; no link is lost, but a chain may stand for a group's pairs."""
    counts = {r["p"]: r["n"] for r in
              nodes.groupBy(F.bit_count("fp").alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    tile_rows = min(tile_rows, max(LEAST_TILE_ROWS, int(sum(counts.values()) * TILE_SHARE)))
    tiles = [-(-counts.get(p, 0) // tile_rows) for p in range(65)]
    base = [sum(tiles[:p]) for p in range(65)]
    per_strip, first = (F.array(*[F.lit(x) for x in xs]) for xs in (tiles, base))
    pop = F.bit_count("fp").cast("int")
    own = F.get(first, pop) + F.pmod(F.xxhash64("fp", F.lit("tile")), F.get(per_strip, pop)).cast("int")
    lowest, highest = F.greatest(pop - radius, F.lit(0)), F.least(pop + radius, F.lit(64))
    end = F.get(first, highest) + F.get(per_strip, highest)
    # Tiles are numbered by strip, so those of the near strips are one run of numbers.
    work = (nodes.select("fp", own.alias("own"), F.get(first, lowest).alias("lo"), end.alias("hi"))
            .select("fp", "own", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("met"))
            .select("fp", "own", F.least("own", "met").alias("a"), F.greatest("own", "met").alias("b")))

    def pair(key, group):
        fps = group.column("fp").to_numpy().view(np.uint64)
        if key[0].as_py() == key[1].as_py():
            u, v = compare_tiles(fps, None, radius)
        else:
            left = group.column("own").to_numpy() == key[0].as_py()
            u, v = compare_tiles(fps[left], fps[~left], radius) if left.any() and not left.all() \
                else (fps[:0], fps[:0])
        return pa.table([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], schema=arrow_schema(_EDGE))

    return work.groupBy("a", "b").applyInArrow(pair, "u long, v long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a smaller one in its connected component, which
    is then the smallest: columns of ``edges`` are u and v, in either order.

    Alternates large-star (every larger neighbour of a node points at the least node around it)
    and small-star (so do its smaller neighbours, and itself) until the edges no longer change.
    Edges point from the larger node ``hi`` to the smaller ``lo``; neither step makes more
    edges than it was given, and rounds grow with the logarithm of the longest chain.  Many edges
    may point at one centre: both sides of the joins are staged files, so AQE can split the centre's
    rows, and least neighbours are partial aggregates.  A step's files go when the next has them.
    """
    spark = edges.sparkSession
    held: list[str] = []

    def hold(df):
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        held.append(path)
        return spark.read.parquet(path)

    def let_go(keep: int):
        while len(held) > keep:
            delete_path(spark, held.pop(0))

    now = hold(edges.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct())
    seen = None
    for _ in range(max_rounds):
        around = now.select(F.col("lo").alias("via"), F.col("hi").alias("x")).union(now.select("hi", "lo"))
        least = hold(around.groupBy("via").agg(F.least(F.min("x"), F.col("via")).alias("m")))
        now = hold(now.join(least, now["lo"] == least["via"]).select("hi", F.col("m").alias("lo")).distinct())
        least = hold(now.groupBy(F.col("hi").alias("via")).agg(F.min("lo").alias("m")))
        small = now.join(least, now["hi"] == least["via"]).where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = hold(small.union(least.select("via", "m")).distinct())
        let_go(1)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per document: doc_id, text_key, fp, root (signed fingerprints), component_id.

    component_id is the smallest doc_id that is reachable over links of at most ``radius``
    differing bits, itself included; root is the smallest fingerprint of the component.
    Null and blank texts have fingerprint 0 and link like any other.  A null doc_id takes
    part in links but names no component unless its whole component has none (then null).
    Repeated rows give repeated rows.  An empty table gives an empty result.  Other columns
    of ``docs`` are not read.
    """
    rows = stage(fingerprints(docs, shingle), "simhash")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius, tile_rows))
    tagged = stage(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                   .select("fp", "rep", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = stage(tagged.groupBy("root").agg(F.min("rep").alias("component_id")), "simhash-least")
    named = tagged.select("fp", "root").join(least, "root")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, with one row left of every near-duplicate group.

    The row with the smallest doc_id stays (null last), ties by text hash; of rows repeated
    in id and text one stays, whatever their other columns.  Null and blank texts are near copies of each
    other.  An empty table gives an empty one.  Columns may have any names besides doc_id and
    text; they are carried, not read.
    """
    found = stage(near_duplicates(docs, shingle, radius), "simhash-found")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k"))
    one, key, row = (free_name(docs, n) for n in ("keep_id", "keep_key", "keep_row"))
    keys = best.select(F.col("k.doc_id").alias(one), F.col("k.text_key").alias(key))
    kept = (docs.withColumn(row, row_key())
            .join(keys, F.col("doc_id").cast("long").eqNullSafe(F.col(one)) & (F.col(row) == F.col(key)), "left_semi"))
    if not found.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", row])
    return kept.drop(row)
