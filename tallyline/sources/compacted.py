"""The compacted layer: deduplicated Parquet, published whole or not at all."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import dedup
from tallyline.schema import KEY, SEQ
from tallyline.sources import raw
from tallyline.sources.files import Files

#: Bytes from which a file's rows win over those of smaller files.
LARGE_FILE = 100 << 20
CODECS = {False: "zstd", True: "lz4"}


@dataclass(frozen=True)
class Report:
    n_files: int
    rows_in: int
    rows_out: int

    @property
    def removed(self) -> int:
        return self.rows_in - self.rows_out


def survivors(spark: SparkSession, folder: str | os.PathLike, *, deduplicate: bool = True, large_file: int = LARGE_FILE, seen: Observation | None = None) -> DataFrame:
    """The records of a raw folder; with ``deduplicate`` one for each key, which large files, then names, then positions decide.

    ``seen`` gets the number of records read before duplicates go, as ``rows``.
    """
    rows = raw.read(spark, folder)
    if not deduplicate:
        return rows
    order = [f"__at{i}" for i in range(len(dedup.survivor_order(large_file)))]
    ranked = rows.select("*", *(o.alias(n) for n, o in zip(order, dedup.survivor_order(large_file), strict=True)))
    ranked = dedup.guarded(ranked)
    return dedup.first_wins(ranked if seen is None else ranked.observe(seen, F.count(F.lit(1)).alias("rows")), order).drop(*order)


def publish(df: DataFrame, target: str | os.PathLike, *, fast: bool = False, partitions: int | None = None) -> int:
    """Write ``df`` beside ``target`` and swap it in; on any failure the old output stays and the new one goes. Returns its rows.

    Rows are sorted by key inside partitions, so row groups can be skipped; there is no
    folder for each key, as keys may be a hundred thousand. Target and staging lie in one folder of one
    file system, whichever it is; rows are counted from the footers of what was written.
    """
    files, target = Files(df.sparkSession), os.fspath(target).rstrip("/")
    folder, _, name = target.rpartition("/")
    folder = folder or "."
    files.make(folder)
    staging, old = (f"{folder}/.{name}.{uuid.uuid4().hex}.{kind}" for kind in ("tmp", "old"))
    try:
        shaped = df.repartitionByRange(partitions, KEY, SEQ) if partitions else df
        shaped.sortWithinPartitions(KEY, SEQ).write.option("compression", CODECS[fast]).parquet(staging)
        rows = df.sparkSession.read.parquet(staging).count()
        if not rows:
            raise ValueError("no rows to publish")
        if files.exists(target):
            files.move(target, old)
        try:
            files.move(staging, target)
        except Exception:
            if files.exists(old):
                files.move(old, target)
            raise
        return rows
    finally:
        for left in (staging, old):
            if files.exists(left):
                files.delete(left)


def compact(spark: SparkSession, folder: str | os.PathLike, target: str | os.PathLike, *, deduplicate: bool = True, fast: bool = False, large_file: int = LARGE_FILE, partitions: int | None = None) -> Report:
    """Union, deduplicate and publish a raw folder. Lines are parsed once: their number is counted as they are read."""
    files = raw.checked_files(spark, folder)
    seen = Observation()
    rows_out = publish(survivors(spark, folder, deduplicate=deduplicate, large_file=large_file, seen=seen), target, fast=fast, partitions=partitions)
    return Report(len(files), seen.get["rows"] if deduplicate else rows_out, rows_out)
