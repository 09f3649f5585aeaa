"""Registered queries of the training-data operators: whole tables, production parameters.

Each query derives its digest columns from what its operator returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fim, licenses, lines, packing, pii, quality, secrets, simhash, toxicity, urls, vector_codes
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op1_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1_decontamination, and n_near and near_items (ids with commas): windows
    with words up to ``decontaminate.SLOP`` off their places."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=decontaminate.SLOP)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated", "n_near", F.array_join("near_items", ",").alias("near_items"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id and digests read back from every formatted conversation, and from number -1."""
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = chat.format_conversations(chat.text_parts(rows.unionByName(extra)))
    back = done.select("conv_id", "formatted", chat.turns_of(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss_text"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence for every document."""
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "evidence")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every document."""
    return licenses.find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every page; the models read whole URLs."""
    return urls.judge(table(spark, sf_dir, "pages"), whole=True).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base measures, base_failed, kept for every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and all spans of every document."""
    kinds = F.array(*[F.lit(k) for k in secrets.KINDS])
    named = lambda col: F.array_join(F.transform(col, lambda x: F.concat_ws(
        ":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{secrets.KINDS[k]}")
    return secrets.find(table(spark, sf_dir, "documents")).select(
        "doc_id", count(0), count(1), count(2), F.sha2(named(F.col("base")), 256).alias("base_sha256"),
        named(F.array_sort(F.concat("base", "more"))).alias("spans"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _spans(*columns: str):
    """Lists of kind:start:end, united by start, then kind as numbered in ``pii.KINDS``."""
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    parts = F.transform(F.concat(*columns), lambda x: F.struct(
        F.split(x, ":")[1].cast("long").alias("start"), F.array_position(kinds, F.split(x, ":")[0]).alias("kind"), x.alias("name")))
    return F.array_join(F.transform(F.array_sort(parts), lambda x: x["name"]), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and all spans of every document."""
    count = lambda k: F.size(F.filter("base", lambda x: x.startswith(f"{k}:"))).cast("long").alias(f"n_{k}")
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        _spans("base", "more").alias("spans"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, digests of output and restored text of every document."""
    done = fim.transform(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every whole vector."""
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    left = lines.drop_repeated(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_chat, op3_toxicity, op4_licenses, op5_urls, op6_quality,
                                   op7_secrets, op8_simhash, op9_pii, op10_packing, op11_fim, op12_vector_codes, op13_lines)}
#: Queries beside those: op1's SQL has exact matches only, and its columns are compared by name.
FURTHER = {f.__name__: f for f in (op1_proximity,)}
