"""Exact deduplication on (key, sequence), whatever the order of arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.schema import KEY, SEQ


def guarded(df: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """``df``, failing when a key or sequence is null or a sequence negative. A guard sits in the scan, not in a job of its own."""
    fine = F.col(key).isNotNull() & F.col(seq).isNotNull() & (F.col(seq).cast("long") >= 0)
    message = F.concat(F.lit("invalid key: "), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(" / "), F.coalesce(F.col(seq).cast("string"), F.lit("null")))
    return df.where(F.when(fine, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def first_wins(df: DataFrame, order: Sequence[Column | str], key: str | Sequence[str] = KEY, seq: str = SEQ) -> DataFrame:
    """The first row by ``order`` of each (key, sequence).

    One aggregation with partial sums before the shuffle, so a key that repeats often is
    reduced where it lies; the sequence in the grouping spreads a key that dominates.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = df.columns
    rank = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = df.select(*keys, F.col(seq).cast("long").alias(seq), F.struct(*(r.alias(f"o{i}") for i, r in enumerate(rank))).alias("__order"), F.struct(*(c for c in columns)).alias("__row"))
    best = packed.groupBy(*keys, seq).agg(F.min_by("__row", "__order").alias("__row"))
    return best.select("__row.*")


def first_wins_window(df: DataFrame, order: Sequence[Column | str], key: str | Sequence[str] = KEY, seq: str = SEQ) -> DataFrame:
    """As ``first_wins``, by a window: for orders that cannot be compared in a struct."""
    keys = [key] if isinstance(key, str) else list(key)
    ranked = Window.partitionBy(*keys, F.col(seq).cast("long")).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def any_wins(df: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """One row of each (key, sequence), where equal keys are known to carry equal rows."""
    return df.dropDuplicates([key, seq])


def survivor_order(threshold: int) -> list[Column]:
    """Files of ``threshold`` bytes or more first, then by name, then by position; use directly above a file scan."""
    return [
        F.col("_metadata.file_size") < F.lit(threshold),
        F.col("_metadata.file_name"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    ]


def accounting(df: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """By key: rows, unique sequences, removed duplicates."""
    each = df.groupBy(key, F.col(seq).cast("long").alias("__seq")).agg(F.count("*").alias("n"))
    out = each.groupBy(key).agg(F.sum("n").alias("rows_in"), F.count("*").alias("rows_out"))
    return out.withColumn("removed", F.col("rows_in") - F.col("rows_out"))


def batches(df: DataFrame, batch: str, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """By batch, in ascending order of arrival: rows, rows kept and removed by exact first-wins deduplication."""
    each = df.groupBy(key, F.col(seq).cast("long").alias("__seq"), batch).agg(F.count("*").alias("n"))
    first = each.groupBy(key, "__seq").agg(F.min(batch).alias(batch)).groupBy(batch).agg(F.count("*").alias("rows_out"))
    rows = each.groupBy(batch).agg(F.sum("n").alias("rows_in"))
    joined = rows.join(first, batch, "left").withColumn("rows_out", F.coalesce("rows_out", F.lit(0)))
    return joined.withColumn("removed", F.col("rows_in") - F.col("rows_out"))


def bitmaps(df: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """By key and bucket of 32,768 sequences, the bitmap of those present: one bit for each."""
    s = F.col(seq).cast("long")
    numbered = df.select(key, F.bitmap_bucket_number(s + 1).alias("bucket"), F.bitmap_bit_position(s + 1).alias("bit"))
    return numbered.groupBy(key, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bitmap_count(df: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """By key, the exact number of distinct sequences, from bitmaps."""
    return bitmaps(df, key, seq).groupBy(key).agg(F.sum(F.bitmap_count("bits")).alias("n_unique"))
