"""A corpus pipeline of five stages over the operators of ``tallyline.llm``.

Every stage takes empty tables, other columns of any name (all but the last hand them on) and texts of any length.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps. ``run`` writes what
a stage returns as Parquet in the shared folder and reads it again as the next one's input.
Each begins with ``unburden``, so that executors don't hold what the stage before needed beside what it needs itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import bpe, decontaminate, jaccard, pii, rff
from tallyline.llm.common import discard, scratch, shared_path, unburden

#: Documents that score lower are rejected.
LEAST_QUALITY = 0.3
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; labels of held-out folds are not learned from.

    Documents without an id are not scored, and stay. Rows that repeat an id go if any text of it is
    rejected. Without labels none is rejected. Null and empty texts are scored like others.
    """
    unburden(spark)
    scored = rff.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    low = scored.where(F.col("score") < LEAST_QUALITY).select(F.col("doc_id").alias("low")).distinct()
    return docs.join(low, docs["doc_id"] == low["low"], "left_anti")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the lowest id; texts without words and without ids stay.

    Rows that repeat an id are one document, of which the first text in order stays.
    """
    unburden(spark)
    joined = jaccard.join(docs).where((F.col("doc_id") != F.col("component_id")) & (F.col("n_shingles") > 0))
    gone = joined.select(F.col("doc_id").alias("gone")).distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
    twice = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("twice")).agg(F.count("*").alias("n")).where("n > 1").select("twice")
    if twice.isEmpty():
        return kept
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", *(c for c in COLUMNS if c not in ("doc_id", "text"))))
    again = kept.join(twice, F.col("doc_id") == F.col("twice"), "left_semi").withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return kept.join(twice, F.col("doc_id") == F.col("twice"), "left_anti").unionByName(again)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none. Every row is judged by its own text, repeated or not."""
    unburden(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, secrets and the terms that reveal them replaced; where there is an n_chars, it follows the text.

    Every row stays; a null text stays null, and so does its length.
    """
    unburden(spark, workers=False)  # all of this stage is native
    done = pii.sanitise(docs)
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source (where there are such), token ids (little-endian unsigned 32-bit) and their number, of every document.

    A null or empty text has no ids.
    """
    unburden(spark)
    kept = tuple(c for c in ("doc_id", "lang", "source") if c in docs.columns)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=kept).select(*kept, "n_tokens", "ids")


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontaminated", decontaminated), ("sanitised", sanitised), ("encoded", encoded)]
#: Classifier, components and encoding are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage wrote for itself goes when its rows are written, and those when the next has read them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        last, path = docs, shared_path(spark, f"stage-{name}")
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        docs._written_to = path
        discard(last)
    return docs
