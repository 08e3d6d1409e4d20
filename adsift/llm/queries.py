"""Registered queries of the corpus operators: ``(spark, sf_dir) -> DataFrame``.

Each applies one operator with production parameters to its whole table and
derives the digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from adsift.llm import (conversation_repair, decontam, jaccard_forest, license_scan, line_dedup, packing, pii, quality,
                        quality_embedding, span_dedup, suffix_dedup, toxicity, vector_codes)
from adsift.llm.common import read_table


def _documents(spark, sf):
    return read_table(spark, sf, "documents")


def _sha256(text):
    return F.sha2(F.encode(text, "utf-8"), 256)


def _tokenizer(name):
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark, sf):
    found = toxicity.score_toxicity(_documents(spark, sf), read_table(spark, sf, "labels"))
    return found.select("row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences",
                        F.size("offending").cast("long").alias("n_offending"))


def op2_suffix_dedup(spark, sf):
    found = suffix_dedup.repeated_substrings(_documents(spark, sf))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def _span_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_pii(spark, sf):
    found = pii.find_personal_data(_documents(spark, sf))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(F.col("id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in pii.KINDS],
                        _sha256(_span_text(F.col("base"))).alias("base_sha256"), _span_text(F.col("spans")).alias("spans"))


def op4_license_scan(spark, sf):
    found = license_scan.scan_licenses(_documents(spark, sf))
    return found.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                        "score", "spans")


def op5_decontamination(spark, sf):
    found = decontam.find_contamination(_documents(spark, sf), read_table(spark, sf, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "start_word", "n_words", "similarity", "distance")


def op6_packing(spark, sf):
    pieces = packing.pack_documents(_documents(spark, sf), _tokenizer("word_bpe_49k.json"))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op7_span_dedup(spark, sf):
    # Repeated stretches of under 20 words (a footer or a heading that many documents share) are left alone.
    found = span_dedup.dedup_spans(_documents(spark, sf), min_words=20)
    return found.select("row.doc_id", "n_sentences", "n_removed", _sha256(F.col("kept_text")).alias("kept_sha256"))


def op8_jaccard_forest(spark, sf):
    found = jaccard_forest.near_duplicates(_documents(spark, sf))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies")


def op9_quality_rules(spark, sf):
    found = quality.apply_quality_rules(_documents(spark, sf))
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def op10_line_dedup(spark, sf):
    found = line_dedup.dedup_lines(_documents(spark, sf))
    return found.select("row.doc_id", "n_lines", "n_dropped", _sha256(F.col("kept_text")).alias("kept_sha256"))


def op11_conversation_repair(spark, sf):
    rows = read_table(spark, sf, "conversations")
    found = conversation_repair.repair_conversations(conversation_repair.damage_conversations(rows))
    every = rows.select("conv_id").distinct().join(
        found.withColumnRenamed("conv_id", "f_conv"), F.col("conv_id").eqNullSafe(F.col("f_conv")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", _sha256(F.lit(""))).alias("repaired_sha256"))


def op12_quality_embedding(spark, sf):
    found = quality_embedding.score_quality(_documents(spark, sf), read_table(spark, sf, "labels"))
    return found.select("row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_vector_codes(spark, sf):
    coded, books = vector_codes.compress_vectors(read_table(spark, sf, "embeddings"))
    return coded.select("row.vec_id", "code", "error", "label_error",
                        F.lit(books.sha256() if books else "").alias("codebooks_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pii": op3_pii,
    "op4_license_scan": op4_license_scan,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_span_dedup": op7_span_dedup,
    "op8_jaccard_forest": op8_jaccard_forest,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_quality_embedding": op12_quality_embedding,
    "op13_vector_codes": op13_vector_codes,
}
