"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a segment holds, for some hundred thousand
consecutive words, the sorted positions of every indexed term and a table of its documents.
Segments are written as Parquet rows to the shared folder.  Test phrases come in blocks of a
bounded size and are sent to every segment; within a segment the position lists of a
phrase, each shifted by its word's offset, are intersected from the term that is rarest in
the whole corpus.  Postings are never shuffled.  Only terms of the block's phrases are
indexed, as no phrase can read the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import stage
from .common import ddl, free_name, record_batch, texts, words

#: Words of a window; shorter items are one window.
WINDOW = 13
#: Words that a word of a near match may be off its place.
SLOP = 2
#: Words after which a segment is closed.
SEGMENT_WORDS = 400_000
#: (window, item) pairs of a block: what is broadcast at once, about 15 MB at most.
BLOCK_PAIRS = 50_000
#: Different words of all windows that are sent to all tasks at most.
MAX_TERMS = 500_000

_SEGMENT = {"segment": "string", "doc_id": "array<long>", "text_key": "array<long>", "n_words": "array<int>",
            "term": "array<string>", "ends": "array<int>", "positions": "binary"}
_FOUND = {"segment": "string", "ordinal": "int", "doc_id": "long", "text_key": "long", "n_words": "int",
          "starts": "array<int>", "ends": "array<int>", "items": "array<string>", "n_near": "long",
          "near_items": "array<string>"}
_WINDOW = {"window": "string", "item_id": "string"}


def text_key():
    """Hash of the whole text (null as empty): tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (window, item_id): the word windows of every item, space-joined.

    Items without words have none.  item_id is text; a null one stays null.
    """
    def run(batches):
        for b in batches:
            cols = {"window": [], "item_id": []}
            for t, item in zip(texts(b), b.column("item_id").to_pylist()):
                ws = [w.decode() for w in words(t)]
                for k in range(max(len(ws) - size + 1, bool(ws))):
                    cols["window"].append(" ".join(ws[k:k + size]))
                    cols["item_id"].append(item)
            yield record_batch(_WINDOW, cols)
    return (items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
            .mapInArrow(run, ddl(_WINDOW)).distinct())


def build_index(docs: DataFrame, terms: list[str] | None = None, gap: int = 64,
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Positional segments of ``docs``, staged in the shared folder.

    ``terms`` restricts the postings (None: all terms).  Documents lie one after the other
    on a segment's number line, ``gap`` places apart, so that no phrase spans two.  A
    document is never split: one longer than a segment is a segment of its own.
    """
    known = None if terms is None else docs.sparkSession.sparkContext.broadcast(
        {w.encode(): k for k, w in enumerate(sorted(terms))})
    names = None if terms is None else sorted(terms)

    def run(batches):
        part, closed, rows = TaskContext.get().partitionId(), 0, []
        ids, at = (None if known is None else known.value), 0
        own: dict[bytes, int] = {}

        def close():
            codes = np.concatenate([r[3] for r in rows])
            places = np.concatenate([r[4] for r in rows])
            order = np.argsort(codes, kind="stable")
            codes, places = codes[order], places[order]
            used, first = np.unique(codes, return_index=True)
            label = [w.decode() for w in own] if names is None else names
            return {"segment": [f"{part}-{closed}"], "doc_id": [[r[0] for r in rows]], "text_key": [[r[1] for r in rows]],
                    "n_words": [[r[2] for r in rows]], "term": [[label[c] for c in used]],
                    "ends": [np.append(first[1:], len(codes)) if len(used) else []],
                    "positions": [places.astype(np.int32).tobytes()]}

        for b in batches:
            for t, doc, key in zip(texts(b), b.column("doc_id").to_pylist(), b.column("text_key").to_pylist()):
                ws = words(t)
                if ids is None:
                    codes = np.fromiter((own.setdefault(w, len(own)) for w in ws), np.int32, len(ws))
                else:
                    codes = np.array([ids.get(w, -1) for w in ws], np.int32)
                hit = np.flatnonzero(codes >= 0)
                rows.append((doc, key, len(ws), codes[hit], hit + at))
                at += len(ws) + gap
                if at >= segment_words:
                    yield record_batch(_SEGMENT, close())
                    closed, rows, at, own = closed + 1, [], 0, {}
        if rows:
            yield record_batch(_SEGMENT, close())

    return stage(docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), F.col("text").cast("string"))
                 .mapInArrow(run, ddl(_SEGMENT)), "postings")


def frequencies(index: DataFrame) -> DataFrame:
    """(term, n): places of every indexed term in the corpus."""
    return (index.select(F.explode(F.arrays_zip("term", "ends",
                         F.concat(F.array(F.lit(0)), "ends").alias("starts"))).alias("x"))
            .where("x.term is not null").groupBy(F.col("x.term").alias("term"))
            .agg(F.sum(F.col("x.ends") - F.col("x.starts")).alias("n")))


def _shifted(places: np.ndarray, starts: np.ndarray, slop: int) -> np.ndarray:
    """Which of ``starts`` have a place at most ``slop`` away."""
    k = np.searchsorted(places, starts)
    after, before = places[np.minimum(k, len(places) - 1)], places[np.maximum(k - 1, 0)]
    return (np.abs(after - starts) <= slop) | (np.abs(starts - before) <= slop)


def match(lists: dict[str, np.ndarray], plan: list[tuple[str, int]], slop: int = 0,
          starts: np.ndarray | None = None) -> np.ndarray:
    """Starts of a phrase: the rarest term's places less its offset (or ``starts``), kept while
    every further term has a place where its offset puts it, or at most ``slop`` away."""
    for term, offset in plan:
        places = lists.get(term)
        if places is None:
            return np.empty(0, np.int64)
        starts = places.astype(np.int64) - offset if starts is None else starts[_shifted(places, starts + offset, slop)]
        if not len(starts):
            break
    return starts


def search(index: DataFrame, phrases: dict[str, list[str]], freq: dict[str, int], slop: int = 0) -> DataFrame:
    """One row per document of ``index``: word intervals covered by exact occurrences of
    ``phrases`` (window -> item ids), the items they belong to, ``n_near``: further places
    (more than ``slop`` words from an exact one) where all words of a phrase lie within
    ``slop`` words of their own place, seen from its rarest word, and the items of those.
    One word of the text may stand for two equal words of a phrase that are so near."""
    plans: dict[str, list] = {}
    for phrase, items in phrases.items():
        ws = phrase.split(" ")
        plan = sorted(((w, k) for k, w in enumerate(ws)), key=lambda x: (freq.get(x[0], 0), x))
        if all(freq.get(w) for w in ws):
            plans.setdefault(plan[0][0], []).append((plan, len(ws), [x for x in items if x is not None]))
    sent = index.sparkSession.sparkContext.broadcast(plans)

    def run(batches):
        for b in batches:
            for seg in b.to_pylist():
                yield record_batch(_FOUND, _in_segment(seg, sent.value, slop))

    return index.mapInArrow(run, ddl(_FOUND))


def _in_segment(seg: dict, plans: dict, slop: int, gap: int = 64) -> dict[str, list]:
    all_places, lo, lists = np.frombuffer(seg["positions"], np.int32), 0, {}
    for term, hi in zip(seg["term"], seg["ends"]):
        lists[term], lo = all_places[lo:hi], hi
    n_words = np.array(seg["n_words"], np.int64)
    base = np.concatenate(([0], np.cumsum(n_words + gap)))
    edge = np.zeros(base[-1] + 1, np.int32)
    items: list[set] = [set() for _ in n_words]
    near = np.zeros(len(n_words), np.int64)
    near_items: list[set] = [set() for _ in n_words]
    for rare in plans.keys() & lists.keys():
        for plan, size, owners in plans[rare]:
            loose = match(lists, plan, slop) if slop else None
            starts = match(lists, plan, 0, loose)  # the exact ones are among the loose ones
            if slop and len(loose) > len(starts):
                if len(starts):
                    loose = loose[~_shifted(starts, loose, slop)]
                # a phrase that lost words at an end of a text starts there
                of = np.searchsorted(base, np.maximum(loose + plan[0][1], 0), "right") - 1
                np.add.at(near, of, 1)
                for d in set(of.tolist()):
                    near_items[d].update(owners)
            if len(starts):
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + size, -1)
                for d in set((np.searchsorted(base, starts, "right") - 1).tolist()):
                    items[d].update(owners)
    change = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(edge) > 0).astype(np.int8), [0]))))
    first, last = change[::2], change[1::2]  # covered intervals on the number line
    of = np.searchsorted(base, first, "right") - 1
    cut = np.searchsorted(of, np.arange(len(n_words) + 1))
    spans = [(first[a:c] - base[d], last[a:c] - base[d]) for d, (a, c) in enumerate(zip(cut[:-1], cut[1:]))]
    n = len(n_words)
    return {"segment": [seg["segment"]] * n, "ordinal": list(range(n)), "doc_id": seg["doc_id"],
            "text_key": seg["text_key"], "n_words": seg["n_words"], "starts": [s for s, _ in spans],
            "ends": [e for _, e in spans], "items": [sorted(x) for x in items], "n_near": near,
            "near_items": [sorted(x) for x in near_items]}


def _merged(found: list[DataFrame]) -> DataFrame:
    """The rows of one or more blocks, intervals and items of a document united."""
    if len(found) == 1:
        return found[0]
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    empty = F.expr("cast(array() as array<struct<starts:int,ends:int>>)")
    last = lambda acc: F.element_at(acc, -1)
    united = F.aggregate(F.col("spans"), empty, lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["ends"] >= x["starts"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1),
                 F.array(F.struct(last(acc)["starts"].alias("starts"),
                                  F.greatest(last(acc)["ends"], x["ends"]).alias("ends")))))
        .otherwise(F.concat(acc, F.array(x))))
    return (every.groupBy("segment", "ordinal")
            .agg(F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"),
                 F.first("n_words").alias("n_words"), spans.alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                 F.sum("n_near").alias("n_near"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"))
            .withColumn("spans", united)
            .select("segment", "ordinal", "doc_id", "text_key", "n_words", F.col("spans.starts").alias("starts"),
                    F.col("spans.ends").alias("ends"), "items", "n_near", "near_items"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0,
                  share: int = 20, block_pairs: int = BLOCK_PAIRS, max_terms: int = MAX_TERMS) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, n_items, items (sorted ids as
    text), contaminated, n_near, near_items (sorted ids as text).

    n_near counts places where a window occurs with words up to ``slop`` off their places, and
    near_items lists its items; both are empty with ``slop`` 0 and do not bear on the others.
    A word is hit if it lies inside any occurrence of a window of ``size`` consecutive item
    words; contaminated: at least one hit and ``share * n_hit >= n_words``.  Null and empty
    texts have no words and are never contaminated; items without words have no windows; a
    null item_id hits words but is not listed.  Repeated documents give repeated rows,
    repeated items one id.  Empty tables: no rows, or no hits.  Other columns are not read.
    """
    pairs = stage(windows(items, size), "windows")
    blocks = max(1, -(-pairs.count() // block_pairs))
    # One index for all blocks: the corpus is read once however long the benchmark is.  Beyond
    # max_terms different words the list of them is not sent and all words are indexed.
    vocabulary = stage(pairs.select(F.explode(F.split("window", " ")).alias("term")).distinct(), "terms")
    terms = [r["term"] for r in vocabulary.collect()] if vocabulary.count() <= max_terms else None
    index = build_index(docs, terms)
    counts = frequencies(index)
    found = []
    for k in range(blocks):
        phrases: dict[str, list[str]] = {}
        own = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == k)
        for r in own.toLocalIterator():
            phrases.setdefault(r["window"], []).append(r["item_id"])
        if k == 0 and blocks > 1:
            counts = stage(counts, "term-counts")
        used = own.select(F.explode(F.split("window", " ")).alias("term")).distinct()
        freq = {r["term"]: r["n"] for r in counts.join(used, "term", "left_semi").toLocalIterator()}
        found.append(search(index, phrases, freq, slop))
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return (_merged(found)
            .select("doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"), "items", "n_near", "near_items")
            .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without contaminated texts.

    Null and empty texts stay.  Repeated rows go or stay together.  Without rows of ``items``
    all rows stay; an empty table gives an empty one.  Columns may have any names besides doc_id
    and text; they are carried, not read.
    """
    one, key, row = (free_name(docs, n) for n in ("bad_id", "bad_key", "bad_row"))
    bad = contamination(docs, items, size).where("contaminated").select(F.col("doc_id").alias(one), F.col("text_key").alias(key))
    return docs.withColumn(row, text_key()).join(
        bad, F.col("doc_id").cast("long").eqNullSafe(F.col(one)) & (F.col(row) == F.col(key)), "left_anti").drop(row)
