"""The raw layer: newline-delimited JSON, appended to, strict when read."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schema import RECORD
from tallyline.sources.files import Entry, Files

#: Files that hand or other tools put there, and those that Spark appends.
PATTERN = "{*.jsonl,part-*.json}"


def checked_files(spark: SparkSession, folder: str | os.PathLike) -> list[Entry]:
    """The raw files of a folder by name; the three ways to have none raise."""
    files = Files(spark)
    if not files.exists(folder):
        raise FileNotFoundError(f"no raw folder at {folder}")
    if not files.is_dir(folder):
        raise NotADirectoryError(f"{folder} is not a folder")
    found = files.matching(folder, PATTERN)
    if not found:
        raise ValueError(f"no {PATTERN} files in {folder}")
    return found


def read(spark: SparkSession, folder: str | os.PathLike, schema: T.StructType = RECORD) -> DataFrame:
    """Every record of a folder. Fields that a line lacks are null, others are left out; a malformed line fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", PATTERN).json(str(folder))


def append(df: DataFrame, folder: str | os.PathLike) -> None:
    """Append records as JSON lines under names that Spark writes; files already there are not touched, and none shows before all are whole."""
    df.write.mode("append").option("ignoreNullFields", "false").format("json").save(str(folder))


def split_blocks(path: str | os.PathLike, block_bytes: int) -> list[tuple[int, int]]:
    """Byte ranges of whole lines, of about ``block_bytes``, that cover a local file; none for an empty one.

    Spark's line reader splits files by itself; this is for callers that need the ranges.
    """
    if block_bytes <= 0:
        raise ValueError("block_bytes must be positive")
    size, out, start = os.path.getsize(path), [], 0
    with open(path, "rb") as file:
        while start < size:
            file.seek(min(start + block_bytes, size))
            file.readline()
            out.append((start, min(file.tell(), size)))
            start = out[-1][1]
    return out


def folder_stats(spark: SparkSession, folder: str | os.PathLike) -> DataFrame:
    """One row: files, bytes and lines of a raw folder."""
    lines = spark.read.option("pathGlobFilter", PATTERN).text(str(folder)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    each = lines.groupBy("path").agg(F.max("size").alias("size"), F.count("*").alias("n"))
    return each.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("n_bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))
