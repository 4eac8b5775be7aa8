"""Exact deduplication of streams, with state that no watermark drops."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyline.schema import KEY, RECORD, SEQ
from tallyline.sources import raw


def raw_stream(spark: SparkSession, folder: str | os.PathLike, schema: T.StructType = RECORD, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", raw.PATTERN)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(str(folder))


def first_seen(stream: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """The first arrival of each (key, sequence), however late a repeat comes.

    State grows with the keys; it is spread by key and sequence, and belongs in RocksDB
    (``spark.sql.streaming.stateStore.providerClass``) once it outgrows memory.
    """
    return stream.dropDuplicates([key, seq])


def run_available(stream: DataFrame, target: str | os.PathLike, checkpoint: str | os.PathLike) -> None:
    """Write what is there now to Parquet, exactly once over restarts, and stop."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(checkpoint)).outputMode("append").trigger(availableNow=True).start(str(target))
    query.awaitTermination()
