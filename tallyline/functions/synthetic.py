"""Deterministic synthetic records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.projection import canonical

START_MS = 1_600_000_000_000


def trades(spark: SparkSession, instruments: int, rows: int, large_rows: int = 0, dup_rate: float = 0.01, seed: int = 7) -> DataFrame:
    """``rows`` records of each of ``instruments`` options, and ``large_rows`` of one perpetual, made by the executors.

    A share ``dup_rate`` of them, drawn by hash of the seed and key, is there twice. Block,
    combo and liquidation fields stay null.
    """
    small = spark.range(instruments * rows).select(F.format_string("BTC-%04d-OPT", F.expr(f"id div {rows}")).alias("instrument_name"), (F.col("id") % rows + 1).alias("trade_seq"))
    large = spark.range(large_rows).select(F.lit("BTC-PERPETUAL").alias("instrument_name"), (F.col("id") + 1).alias("trade_seq"))
    base = small.unionByName(large)
    draw = F.pmod(F.xxhash64("instrument_name", "trade_seq", F.lit(seed)), F.lit(1_000_000))
    s = F.col("trade_seq")
    wave = F.pmod(F.xxhash64("instrument_name", "trade_seq"), F.lit(1000)).cast("double")
    rows_ = base.withColumn("copies", F.when(draw < int(dup_rate * 1_000_000), 2).otherwise(1)).select("instrument_name", "trade_seq", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    return canonical(
        rows_,
        {
            "trade_seq": "trade_seq", "trade_id": F.concat_ws("-", "instrument_name", s.cast("string")), "timestamp": START_MS + s * 1000, "tick_direction": s % 4,
            "price": 100 + wave / 10, "mark_price": 100 + wave / 11, "iv": 40 + wave / 50, "instrument_name": "instrument_name", "index_price": 100 + wave / 9,
            "direction": F.when(s % 2 == 0, "buy").otherwise("sell"), "amount": 1 + wave / 100, "contracts": 1 + wave / 100,
        },
    )
