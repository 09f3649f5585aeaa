"""Small frames for the operators' edge cases."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = DOCS + ", score double, fp long, item_id long, words array<string>"


def frame(spark, texts, ids=None, parts=3):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def extra(spark, texts, ids=None):
    """The same with more columns, whose names clash with those of results."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), 0.5, 1, 2, ["x"]) for i, t in zip(ids, texts)], EXTRA)
