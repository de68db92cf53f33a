"""Registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (
    conversations,
    embedding_dedup,
    jaccard_join,
    language,
    licenses,
    line_dedup,
    merkle,
    mixing,
    nearest,
    packing,
    quality,
    token_counts,
    toxicity,
)
from tidemark.llm._tables import fold, labelled_sample, table

#: Labelled rows that a classifier is fitted on at most, whatever the size of the tables.
TOXICITY_SAMPLE, QUALITY_SAMPLE = 12_000, 3_000
TOXICITY_FOLDS, TOXICITY_HELD = 4, 2
QUALITY_FOLDS, QUALITY_HELD = 5, 0
LANGUAGE_FOLDS, LANGUAGE_HELD = 4, 2
TOKEN_LIMIT = 1024
NEIGHBOURS, QUERY_EVERY = 20, 20
TAMPERED_EVERY = 7
DAMAGE_CODES = 20


def _held_out(folds, held):
    return F.coalesce(fold("doc_id", folds) == held, F.lit(False))


def toxicity_model(documents, labels):
    training = fold("doc_id", TOXICITY_FOLDS) != TOXICITY_HELD
    return toxicity.train(documents, labelled_sample(documents, labels, "toxic", training, TOXICITY_SAMPLE))


def quality_model(documents, labels):
    training = fold("doc_id", QUALITY_FOLDS) != QUALITY_HELD
    return quality.train(labelled_sample(documents, labels, "quality", training, QUALITY_SAMPLE))


def op1_toxicity(spark, sf_dir):
    """Every document with its toxicity; rows with null doc_id are not held out and teach nothing."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity_model(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        _held_out(TOXICITY_FOLDS, TOXICITY_HELD).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "toxic_words",
    )


def op2_token_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_chars")


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_nearest(spark, sf_dir):
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0, NEIGHBOURS)


def op5_quality(spark, sf_dir):
    """Every document with its quality; rows with null doc_id are not held out and teach nothing."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(documents, quality_model(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        _held_out(QUALITY_FOLDS, QUALITY_HELD).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents.filter(fold("doc_id", LANGUAGE_FOLDS) != LANGUAGE_HELD))
    return language.predict(documents.select("doc_id", "text"), model).select(
        "doc_id", _held_out(LANGUAGE_FOLDS, LANGUAGE_HELD).alias("held_out"), "lang_pred", "score"
    )


def op8_mixing(spark, sf_dir):
    return mixing.mix_ids(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))


def op10_license_scan(spark, sf_dir):
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op11_merkle(spark, sf_dir):
    """Every document with its proof; a null doc_id is not tampered with."""
    tampered = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0,
        F.col("n_chars").cast("decimal(20)") + 1,
    ).otherwise(F.col("n_chars").cast("decimal(20)"))

    def leaf(n_chars):
        return merkle.digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), leaf(tampered).alias("given")
    )
    return (
        merkle.manifest(leaves, "leaf", "lang", ["doc_id"])
        .withColumn("folded_root", merkle.folded(F.col("given"), "proof"))
        .select(
            "doc_id",
            "leaf",
            "subroot",
            "root",
            merkle.proof_digest("proof").alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def op12_conversation_repair(spark, sf_dir):
    """Conversations damaged by a code of each row, and what repairs them."""
    code = conversations.damage_code("conv_id", "turn", DAMAGE_CODES)
    role, text = (F.coalesce(name, F.lit(" ")) for name in ("role", "text"))
    damaged = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(code == 0, "").when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code <= 1, "").when(code == 2, F.translate(text, conversations.ENDS, "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )
    return conversations.audit(damaged)


def op13_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_token_counts,
        op3_packing,
        op4_nearest,
        op5_quality,
        op6_embedding_dedup,
        op7_language,
        op8_mixing,
        op9_jaccard_join,
        op10_license_scan,
        op11_merkle,
        op12_conversation_repair,
        op13_line_dedup,
    )
}
