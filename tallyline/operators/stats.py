"""Statistics by key, and totals over keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.schema import KEY, SEQ, TIME


def by_key(df: DataFrame, key: str = KEY, seq: str = SEQ, time: str | None = TIME) -> DataFrame:
    """rows, unique sequences (null counts as a value), least and largest sequence and time of each key.

    (key, sequence) is aggregated first: a key that dominates is spread by its sequences.
    """
    s = F.col(seq).cast("long")
    times = [] if time is None else [F.min(time).alias("t0"), F.max(time).alias("t1")]
    each = df.groupBy(key, s.alias("__seq")).agg(F.count("*").alias("n"), *times)
    times = [] if time is None else [F.min("t0").alias("ts_min"), F.max("t1").alias("ts_max")]
    return each.groupBy(key).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_unique"), F.min("__seq").alias("seq_min"), F.max("__seq").alias("seq_max"), *times)


def totals(stats: DataFrame) -> DataFrame:
    """One row: rows and keys over all, and the UTC dates of the first and last time (epoch ms)."""
    # By days since the epoch, so that the session's time zone has no say.
    day = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), F.floor(c / 86_400_000).cast("int")).cast("string")
    return stats.agg(
        F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_keys"), day(F.min("ts_min").cast("long")).alias("first_day"), day(F.max("ts_max").cast("long")).alias("last_day")
    )
