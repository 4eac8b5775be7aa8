"""Schemas of records, ledgers and catalogues, declared once and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed field list of a trade record, in order.
RECORD = T.StructType(
    [
        T.StructField("trade_seq", T.LongType()),
        T.StructField("trade_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("tick_direction", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("mark_price", T.DoubleType()),
        T.StructField("iv", T.DoubleType()),
        T.StructField("instrument_name", T.StringType()),
        T.StructField("index_price", T.DoubleType()),
        T.StructField("direction", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("contracts", T.DoubleType()),
        T.StructField("block_trade_id", T.StringType()),
        T.StructField("block_rfq_id", T.StringType()),
        T.StructField("block_trade_leg_count", T.LongType()),
        T.StructField("combo_id", T.StringType()),
        T.StructField("combo_trade_id", T.StringType()),
        T.StructField("liquidation", T.StringType()),
    ]
)
KEY, SEQ, TIME = "instrument_name", "trade_seq", "timestamp"

#: Ledgers: what is known of each instrument, and of each planned range of a future.
FUTURE_META = T.StructType([T.StructField("instrument", T.StringType()), T.StructField("is_expired", T.IntegerType()), T.StructField("is_completed", T.IntegerType())])
FUTURE_CHUNK = T.StructType(
    [T.StructField("instrument", T.StringType()), T.StructField("chunk_no", T.LongType()), T.StructField("count", T.LongType()), T.StructField("has_more", T.IntegerType()), T.StructField("is_done", T.IntegerType())]
)
OPTION_META = T.StructType(
    [T.StructField("instrument", T.StringType()), T.StructField("last_no", T.LongType()), T.StructField("is_expired", T.IntegerType()), T.StructField("is_completed", T.IntegerType())]
)
LEDGERS = {"future_meta": FUTURE_META, "future_chunk": FUTURE_CHUNK, "option_meta": OPTION_META}
#: A completeness bound: ``max_seq`` of a key, and whether it is final.
TARGET = T.StructType([T.StructField("instrument_name", T.StringType()), T.StructField("max_seq", T.LongType()), T.StructField("is_complete", T.BooleanType())])
KINDS = ("future", "option")
