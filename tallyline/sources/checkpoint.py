"""Ledger stores: versioned Parquet snapshots, and SQLite files of an earlier ingest."""

from __future__ import annotations

import json
import os
import sqlite3
import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import ledger
from tallyline.schema import KINDS, LEDGERS
from tallyline.sources.files import Files

LEDGER_KEYS = {"future_meta": ("instrument",), "future_chunk": ("instrument", "chunk_no"), "option_meta": ("instrument",)}
#: Folders of a table from which the next delta merges them into one.
MOST_DELTAS = 32


class SnapshotStore:
    """Ledger tables as snapshots with deltas, on any of Spark's file systems.

    A pointer file names the current version and is replaced in one step; a version is a JSON list of the
    folders that each table consists of: a whole one and the deltas since, of which a later row of a key
    replaces earlier ones. So a commit writes what changed, and a reader sees one version of all tables.
    Folders that neither the current version nor the two before name are deleted. There is one writer.
    """

    def __init__(self, spark: SparkSession, root: str | os.PathLike):
        self.spark, self.root, self.files = spark, os.fspath(root).rstrip("/"), Files(spark)

    def exists(self) -> bool:
        return self.files.exists(f"{self.root}/CURRENT")

    def _versions(self) -> list[dict[str, list[str]]]:
        """The current version and those before it that are kept, newest first."""
        return json.loads(self.files.read_text(f"{self.root}/CURRENT")) if self.exists() else []

    def read(self, name: str) -> DataFrame:
        schema, kept = LEDGERS[name], (self._versions() or [{}])[0].get(name, [])
        if not kept:
            return self.spark.createDataFrame([], schema)
        if len(kept) == 1:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{kept[0]}")
        keys = LEDGER_KEYS[name]
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/{p}").withColumn("__n", F.lit(n)) for n, p in enumerate(kept)]
        rows = reduce(DataFrame.unionByName, parts)
        rest = [f.name for f in schema if f.name not in keys]
        latest = rows.groupBy(*keys).agg(F.max(F.struct("__n", *rest)).alias("__row"))
        return latest.select(*(k for k in keys), *(F.col(f"__row.{r}").alias(r) for r in rest)).select(*schema.names)

    def commit(self, **tables: DataFrame) -> None:
        """A new version with ``tables`` replaced and the others as they are."""
        self._add({name: [self._written(name, df)] for name, df in tables.items()})

    def append(self, **tables: DataFrame) -> None:
        """A new version in which the rows of ``tables`` replace those of their keys, or are new; only they are written."""
        versions = self._versions()
        now = versions[0] if versions else {}
        if long := {name: df for name, df in tables.items() if len(now.get(name, ())) >= MOST_DELTAS}:
            self.commit(**{name: self.read(name) for name in long})
            now = self._versions()[0]
        self._add({name: [*now.get(name, ()), self._written(name, df)] for name, df in tables.items()})

    def _written(self, name: str, df: DataFrame) -> str:
        path = f"{name}-{uuid.uuid4().hex}"
        schema = LEDGERS[name]
        df.select(*(df[f.name].cast(f.dataType).alias(f.name) for f in schema)).coalesce(8).write.parquet(f"{self.root}/{path}")
        return path

    def _add(self, changed: dict[str, list[str]]) -> None:
        versions = self._versions()
        fresh = [(versions[0] if versions else {}) | changed, *versions][:3]
        self.files.write_text(f"{self.root}/CURRENT", json.dumps(fresh))
        held = {p for version in fresh for paths in version.values() for p in paths}
        for entry in self.files.list(self.root):
            if entry.is_dir and entry.name not in held:
                self.files.delete(entry.path)


#: Fixed table definitions of SQLite ledgers.
SQLITE_TABLES = {
    "future_meta": "instrument TEXT PRIMARY KEY, is_expired INTEGER NOT NULL DEFAULT 0, is_completed INTEGER NOT NULL DEFAULT 0",
    "future_chunk": "instrument TEXT, chunk_no INTEGER, count INTEGER DEFAULT 0, has_more INTEGER, is_done INTEGER NOT NULL DEFAULT 0, PRIMARY KEY (instrument, chunk_no)",
    "option_meta": "instrument TEXT PRIMARY KEY, last_no INTEGER DEFAULT 0, is_expired INTEGER NOT NULL DEFAULT 0, is_completed INTEGER NOT NULL DEFAULT 0",
}


def create_sqlite(path: str | os.PathLike) -> None:
    with sqlite3.connect(path) as db:
        for name, columns in SQLITE_TABLES.items():
            db.execute(f"CREATE TABLE IF NOT EXISTS {name} ({columns})")


def read_sqlite(spark: SparkSession, path: str | os.PathLike, name: str) -> DataFrame:
    """A ledger table of a SQLite file. Ledgers have a row for each planned range: small, and read by the driver."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"no ledger at {path}")
    schema = LEDGERS[name]
    with sqlite3.connect(f"file:{Path(path).resolve()}?mode=ro", uri=True) as db:
        columns = ", ".join(f'"{f.name}"' for f in schema)
        rows = db.execute(f"SELECT {columns} FROM {name}").fetchall()
    return spark.createDataFrame(rows, schema)


def write_sqlite(df: DataFrame, path: str | os.PathLike, name: str) -> None:
    """Replace a ledger table of a SQLite file in one transaction."""
    create_sqlite(path)
    fields = [f.name for f in LEDGERS[name]]
    with sqlite3.connect(path) as db:
        db.execute(f"DELETE FROM {name}")
        db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(fields))})", (tuple(r) for r in df.select(*fields).toLocalIterator()))


def targets(spark: SparkSession, path: str | os.PathLike, kind: str) -> DataFrame:
    """The completeness bounds of a ledger: a folder of snapshots, or a SQLite file."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}, not {kind!r}")
    store = SnapshotStore(spark, path)
    table = store.read if store.exists() else lambda name: read_sqlite(spark, path, name)
    if kind == "option":
        return ledger.option_targets(table("option_meta"))
    return ledger.future_targets(table("future_meta"), table("future_chunk"))


def ledger_of(spark: SparkSession, base_dir: str | os.PathLike, kind: str) -> str:
    """Where the ledger of a kind is: the snapshots of this engine's ingest, or else the SQLite file of an earlier one."""
    own = f"{os.fspath(base_dir).rstrip('/')}/{kind}"
    return f"{own}.ledger" if SnapshotStore(spark, f"{own}.ledger").exists() else f"{own}.db"
