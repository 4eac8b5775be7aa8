"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, ctw, decontaminate, jaccard, ngram_llr, pii, preference, rff, wavelet, wrapper

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again, as digests."""
    done = bpe.encode(_table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN, decoded=True)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded into wavelet-matrix shards, which are then read back."""
    manifest = wavelet.write(_table(spark, sf_dir, "documents"), WORD_BPE, 2)
    return wavelet.read_documents(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text under the context tree and the unigram base."""
    return ctw.score(_table(spark, sf_dir, "documents"))


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen against another answer to its history, as prompt and masked completions."""
    done = preference.contrasts(_table(spark, sf_dir, "conversations"))
    masks = {m: preference.mask_text(F.col(m)) for m in ("chosen_mask", "rejected_mask")}
    return done.withColumns(masks)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near copies."""
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op6_pigeonhole_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds a benchmark item, with the item and where it stands."""
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_ngram_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of every document."""
    docs = _table(spark, sf_dir, "documents")
    labels = ngram_llr.training(_table(spark, sf_dir, "labels"))
    learned = ngram_llr.weights(docs, ngram_llr.trusted(labels))
    return ngram_llr.verdicts(docs, learned, labels)


def op8_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    text = F.coalesce("text", F.lit(""))
    return wrapper.main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op9_rff_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated quality score of every document."""
    scored = rff.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data, of secrets, and of the terms that reveal them (``term`` is generalised, ``drop`` removed)."""
    found = pii.spans(_table(spark, sf_dir, "documents"))
    every = F.array_sort(F.concat("base", "terms"))
    numbers = [*(f"n_{k}" for k in pii.KINDS), F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(every).alias("spans")]
    return found.select("doc_id", *numbers, f"n_{pii.SECRET}", F.size(every).cast("long").alias("n_spans"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_wavelet_shards": op2_wavelet_shards,
    "op3_context_tree": op3_context_tree,
    "op4_preference_format": op4_preference_format,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_pigeonhole_decontaminate": op6_pigeonhole_decontaminate,
    "op7_ngram_llr": op7_ngram_llr,
    "op8_wrapper_text": op8_wrapper_text,
    "op9_rff_quality": op9_rff_quality,
    "op10_disclosure_pii": op10_disclosure_pii,
}
ORACLES: dict[str, str] = {
    "op4_preference_format": preference.ORACLE,
    "op5_jaccard_join": jaccard.ORACLE,
}
