"""Ingest: plan from the ledger, read proved ranges, land them, then move the ledger.

Records are on disk before the ledger says so; a crash between repeats records, which
compaction removes, and never loses any. Ranges that fail are tried again after the others;
those that still fail stay pending and are raised together at the end, with their causes.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.config import Settings
from tallyline.reports import log
from tallyline.operators import ledger
from tallyline.plans import planning
from tallyline.schema import RECORD, SEQ
from tallyline.sources import raw
from tallyline.sources.checkpoint import SnapshotStore
from tallyline.sources.files import Files
from tallyline.sources.history import RANGED, History, HistorySource

#: Times a range is tried before it counts as failed.
TASK_ATTEMPTS = 3


class FailedRanges(Exception):
    """Ranges that could not be proved whole, each with its cause; they stay pending."""

    def __init__(self, causes: dict[tuple[str, int, int], str]):
        shown = ", ".join(f"{i} [{a}, {b}] ({why})" for (i, a, b), why in [*causes.items()][:5])
        super().__init__(f"{len(causes)} ranges failed: {shown}{', …' if len(causes) > 5 else ''}")
        self.ranges, self.causes = [*causes], causes


@dataclass(frozen=True)
class Progress:
    """Where an ingest stands; given to the hook after each batch."""

    kind: str
    planned: int
    landed: int
    failed: int
    records: int
    seconds: float

    def __str__(self) -> str:
        done = self.landed + self.failed
        left = self.seconds / done * (self.planned - done) if done else 0.0
        return f"{self.kind}: {done:,} of {self.planned:,} ranges, {self.failed:,} failed, {self.records:,} records, {self.records / max(self.seconds, 1e-9):,.0f} a second, {left:,.0f} s left"


def log_progress(progress: Progress) -> None:
    log.info("%s", progress)


@dataclass
class Plan:
    ranges: list[tuple[str, int, int]]
    states: DataFrame


def list_instruments(spark: SparkSession, history: History, settings: Settings, kind: str) -> DataFrame:
    """The source's instruments as (instrument, is_expired); also kept as JSON beside the raw files, where that can be written."""
    rows = history.instruments(settings.currency, kind)
    files, folder = Files(spark), settings.raw_dir(kind)
    try:
        files.make(folder)
        files.write_text(f"{folder}/instruments.json", json.dumps(rows))
    except Py4JJavaError as error:
        log.warning("instruments.json was not saved: %s", error.java_exception)
    return spark.createDataFrame([(r["instrument_name"], int(not r["is_active"])) for r in rows], "instrument string, is_expired int")


def prepare_futures(spark: SparkSession, store: SnapshotStore, history: History, settings: Settings) -> Plan | None:
    """Merge the instrument list, plan chunks to the bounds the source confirms, and name the pending ranges.

    Unknown bounds plan nothing and complete nothing; confirmed empty ones complete expired
    instruments only. None where all is complete.
    """
    meta = ledger.upsert(store.read("future_meta"), list_instruments(spark, history, settings, "future"))
    store.commit(future_meta=meta)
    meta = store.read("future_meta")
    names = [r.instrument for r in ledger.incomplete(meta).select("instrument").toLocalIterator()]
    if not names:
        return None
    bounds = spark.createDataFrame(history.last_seqs(names, settings.max_workers), "instrument string, last_seq long")
    states = planning.triaged(ledger.incomplete(meta).select("instrument"), bounds)
    chunks = ledger.insert_chunks(store.read("future_chunk"), planning.chunk_plan(bounds, settings.chunk_size))
    store.commit(future_meta=ledger.mark_complete(meta, planning.confirmed_empty(states, meta)), future_chunk=chunks)
    pending = planning.bounded_pending(ledger.pending(store.read("future_chunk")), bounds, settings.chunk_size)
    return Plan([(r.instrument, r.chunk_no, r.end_seq) for r in pending.orderBy("instrument", "chunk_no").toLocalIterator()], states)


def prepare_options(spark: SparkSession, store: SnapshotStore, history: History, settings: Settings) -> Plan | None:
    """Merge the instrument list and continue each incomplete option after its last known sequence, in proved ranges."""
    meta = ledger.upsert(store.read("option_meta"), list_instruments(spark, history, settings, "option"))
    store.commit(option_meta=meta)
    open_ = ledger.incomplete(store.read("option_meta")).select("instrument", "last_no").collect()
    if not open_:
        return None
    ranges, bounds = [], history.last_seqs([r.instrument for r in open_], settings.max_workers)
    for row, (_, last) in zip(open_, bounds, strict=True):
        for start in range(row.last_no + 1, (last or 0) + 1, settings.chunk_size):
            ranges.append((row.instrument, start, min(start + settings.chunk_size - 1, last)))
    states = planning.triaged(store.read("option_meta").select("instrument"), spark.createDataFrame(bounds, "instrument string, last_seq long"))
    return Plan(sorted(ranges), states)


@dataclass(frozen=True)
class Landed:
    """Of a batch: the proved ranges with their counts, the others with their causes, and the records."""

    done: dict[tuple[str, int, int], int]
    causes: dict[tuple[str, int, int], str]
    records: int


def land(spark: SparkSession, ranges: list[tuple[str, int, int]], folder: str | os.PathLike, options: dict[str, str]) -> Landed:
    """Read ranges once and append them to the raw folder; what is said of them is counted from what was read.

    The batch lies beside the raw files for as long as it is appended, under a name of its own
    that raw scans do not see, on Spark's file system: every executor and the driver find it.
    """
    spark.dataSource.register(HistorySource)
    reader = spark.read.format("history").options(**options).option("ranges", json.dumps(ranges)).option("on_error", "report")
    files, batch = Files(spark), f"{os.fspath(folder).rstrip('/')}/.batch-{uuid.uuid4().hex}"
    try:
        reader.load().write.parquet(batch)
        held = spark.read.schema(RANGED).parquet(batch)
        raw.append(held.where("error is null").select(*RECORD.names), folder)
        each = held.groupBy("range_instrument", "range_start", "range_end").agg(F.max("error").alias("error"), F.count_distinct(SEQ).alias("n"), F.count(SEQ).alias("records")).collect()
    finally:
        files.delete(batch)
    found = {(r.range_instrument, r.range_start, r.range_end): r for r in each}
    done = {r: found[r].n for r in ranges if r in found and found[r].error is None and found[r].n == r[2] - r[1] + 1}
    causes = {r: (found[r].error if r in found else None) or "no rows" for r in ranges if r not in done}
    return Landed(done, causes, sum(r.records for r in each))


def run(
    spark: SparkSession, kind: str, settings: Settings, history: History, options: dict[str, str], *,
    batch: int = 64, stop: Callable[[], bool] = lambda: False, on_batch: Callable[[Progress], None] = log_progress, attempts: int = TASK_ATTEMPTS,
) -> int:
    """One ingest of a kind; returns the ranges that were landed. ``stop`` is asked, and ``on_batch`` told, between batches.

    A range that failed is tried again after the others, ``attempts`` times in all; those that still fail
    are raised with their causes. Offsets move over whole ranges from the start of each instrument only, so a failed range
    is never skipped. The ledger is finalised even when there is nothing to do.
    """
    store = SnapshotStore(spark, settings.base_dir / f"{kind}.ledger")
    plan = (prepare_futures if kind == "future" else prepare_options)(spark, store, history, settings)
    done: set[tuple[str, int, int]] = set()
    causes: dict[tuple[str, int, int], str] = {}
    records, began = 0, time.monotonic()
    if plan:
        folder = settings.raw_dir(kind)
        Files(spark).make(folder)
        todo = plan.ranges
        for _ in range(attempts):
            for k in range(0, len(todo), batch):
                if stop():
                    break
                got = land(spark, todo[k : k + batch], folder, options)
                done |= got.done.keys()
                causes = {r: why for r, why in causes.items() if r not in got.done} | got.causes
                records += got.records
                _move(spark, store, kind, got.done, plan.ranges, done)
                on_batch(Progress(kind, len(plan.ranges), len(done), len(causes), records, time.monotonic() - began))
            todo = [*causes]
            if not todo or stop():
                break
    _finish(spark, store, kind, settings, plan)
    if causes:
        raise FailedRanges(causes)
    return len(done)


def _move(spark: SparkSession, store: SnapshotStore, kind: str, landed: dict, planned: list, done: set) -> None:
    """Write what the ledger gains by the ranges that have just landed, and no more."""
    if not landed:
        return
    if kind == "future":
        seen = spark.createDataFrame([(i, a, n, 0) for (i, a, _), n in landed.items()], "instrument string, chunk_no long, count long, has_more int")
        chunks = store.read("future_chunk").join(F.broadcast(seen.select("instrument", "chunk_no")), ["instrument", "chunk_no"], "left_semi")
        store.append(future_chunk=ledger.update_chunks(chunks, seen))
        return
    moved, tops, blocked = {i for i, *_ in landed}, {}, set()
    for r in planned:  # by instrument and start
        if r[0] in moved and r[0] not in blocked:
            if r in done:
                tops[r[0]] = r[2]
            else:
                blocked.add(r[0])
    if tops:
        offsets = spark.createDataFrame([*tops.items()], "instrument string, last_no long")
        meta = store.read("option_meta").join(F.broadcast(offsets.select("instrument")), "instrument", "left_semi")
        store.append(option_meta=ledger.advance(meta, offsets))


def _finish(spark: SparkSession, store: SnapshotStore, kind: str, settings: Settings, plan: Plan | None) -> None:
    if kind == "future":
        meta, chunks = store.read("future_meta"), store.read("future_chunk")
        store.commit(future_chunk=ledger.finalize_chunks(chunks, meta, settings.chunk_size))
        store.commit(future_meta=ledger.finalize_meta(meta, store.read("future_chunk")))
    elif plan:
        meta = store.read("option_meta")
        reached = plan.states.where("last_seq is not null").join(meta, "instrument").where("is_expired = 1 and last_no >= last_seq")
        store.commit(option_meta=ledger.mark_complete(meta, reached))
