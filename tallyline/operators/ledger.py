"""Ledger transitions as functions from DataFrames to DataFrames.

A ledger never regresses: an offset only grows, what is complete stays so, and an
unknown bound is never taken for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = ["instrument", "chunk_no"]


def upsert(meta: DataFrame, listed: DataFrame) -> DataFrame:
    """``listed`` (instrument, is_expired) merged in: new rows start at zero, known ones change ``is_expired`` only.

    An instrument listed twice counts as expired if any row says so.
    """
    new = listed.groupBy("instrument").agg(F.max("is_expired").alias("__new"))
    merged = meta.join(new, "instrument", "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(meta.schema[c].dataType).alias(c)
    expired = F.coalesce("__new", "is_expired").cast("int").alias("is_expired")
    return merged.select(*(expired if c == "is_expired" else F.col(c) if c == "instrument" else zero(c) for c in meta.columns))


def incomplete(meta: DataFrame) -> DataFrame:
    return meta.where("is_completed = 0")


def pending(chunks: DataFrame) -> DataFrame:
    return chunks.where("is_done = 0")


def insert_chunks(chunks: DataFrame, planned: DataFrame) -> DataFrame:
    """Chunks with those of ``planned`` (instrument, chunk_no) that are not there yet."""
    fresh = planned.select(*CHUNK).distinct().join(chunks, CHUNK, "left_anti")
    rows = fresh.select("instrument", F.col("chunk_no").cast("long"), F.lit(0).cast("long").alias("count"), F.lit(None).cast("int").alias("has_more"), F.lit(0).alias("is_done"))
    return chunks.unionByName(rows)


def update_chunks(chunks: DataFrame, seen: DataFrame) -> DataFrame:
    """Set count and has_more from ``seen`` (instrument, chunk_no, count, has_more), one row a chunk."""
    new = seen.select(*CHUNK, F.col("count").alias("__count"), F.col("has_more").alias("__more"), F.lit(True).alias("__seen"))
    joined = chunks.join(new, CHUNK, "left")
    count = F.when(F.col("__seen"), F.col("__count")).otherwise(F.col("count")).cast("long").alias("count")
    more = F.when(F.col("__seen"), F.col("__more")).otherwise(F.col("has_more")).cast("int").alias("has_more")
    return joined.select(*CHUNK, count, more, "is_done")


def mark_complete(meta: DataFrame, finished: DataFrame) -> DataFrame:
    """Set is_completed for the instruments of ``finished``."""
    done = finished.select("instrument").distinct().withColumn("__done", F.lit(1))
    joined = meta.join(done, "instrument", "left")
    return joined.withColumn("is_completed", F.coalesce("__done", "is_completed")).select(*meta.columns)


def finalize_chunks(chunks: DataFrame, meta: DataFrame, chunk_size: int) -> DataFrame:
    """A chunk is done once nothing follows it and it is full, or its instrument has expired; a partial tail of an active one waits."""
    expired = meta.where("is_expired = 1").select("instrument").distinct().withColumn("__expired", F.lit(True))
    joined = chunks.join(expired, "instrument", "left")
    ends = (F.col("has_more") == 0) & ((F.col("count") >= chunk_size) | F.col("__expired"))
    return joined.withColumn("is_done", F.when(F.coalesce(ends, F.lit(False)), F.lit(1)).otherwise(F.col("is_done"))).select(*chunks.columns)


def finalize_meta(meta: DataFrame, chunks: DataFrame) -> DataFrame:
    """An expired instrument is complete once it has chunks and none is pending.

    One aggregate of the chunks decides both, so no null-aware anti join is planned.
    """
    state = chunks.groupBy("instrument").agg(F.min("is_done").alias("__least"))
    joined = meta.join(state, "instrument", "left")
    whole = (F.col("is_expired") == 1) & (F.col("__least") == 1)
    return joined.withColumn("is_completed", F.when(F.coalesce(whole, F.lit(False)), F.lit(1)).otherwise(F.col("is_completed"))).select(*meta.columns)


def advance(meta: DataFrame, offsets: DataFrame) -> DataFrame:
    """Raise last_no to that of ``offsets`` (instrument, last_no); a lower one changes nothing."""
    new = offsets.groupBy("instrument").agg(F.max("last_no").alias("__new"))
    joined = meta.join(new, "instrument", "left")
    return joined.withColumn("last_no", F.greatest("last_no", "__new").cast("long")).select(*meta.columns)


def future_targets(meta: DataFrame, chunks: DataFrame) -> DataFrame:
    """By instrument: the last sequence its done chunks reach, and whether that is final."""
    reach = F.when((F.col("is_done") == 1) & (F.col("count") > 0), F.col("chunk_no") + F.col("count") - 1).otherwise(F.lit(0))
    top = chunks.groupBy("instrument").agg(F.max(reach).alias("__top"))
    joined = meta.join(top, "instrument", "left")
    return joined.select(F.col("instrument").alias("instrument_name"), F.coalesce("__top", F.lit(0)).cast("long").alias("max_seq"), (F.col("is_completed") == 1).alias("is_complete"))


def option_targets(meta: DataFrame) -> DataFrame:
    return meta.select(F.col("instrument").alias("instrument_name"), F.col("last_no").cast("long").alias("max_seq"), (F.col("is_completed") == 1).alias("is_complete"))
