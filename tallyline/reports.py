"""Reports for people: validation on a terminal, benchmark tables in Markdown."""

from __future__ import annotations

import logging
import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import stats, validate
from tallyline.sources import checkpoint
from tallyline.sources.files import Files

log = logging.getLogger("tallyline")


def setup_logging(level: int = logging.INFO) -> None:
    """Messages of this package to standard error, once."""
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
    log.setLevel(level)


def validation(df: DataFrame, targets: DataFrame | None, path: str | os.PathLike, shown: int = 50) -> tuple[list[str], validate.Result]:
    """The lines of a report: fields, keys that are not complete, their gaps, totals; and the result.

    Only the ``shown`` first keys by name are listed; every key is counted. Records are read once for the
    statistics, which are kept for all that follows, and once more for the gaps, if there are any.
    """
    by = stats.by_key(df).persist()
    try:
        return _validation(df, by, targets, path, shown)
    finally:
        by.unpersist()


def _validation(df: DataFrame, by: DataFrame, targets: DataFrame | None, path: str | os.PathLike, shown: int) -> tuple[list[str], validate.Result]:
    details, result = validate.validate_stats(by, targets)
    totals = stats.totals(by).first()
    lines = ["fields: " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)]
    for r in details.where(F.col("status") != validate.COMPLETE).orderBy("instrument_name").limit(shown).collect():
        lines.append(f"{r.instrument_name}: {r.status}, {r.n_rows:,} rows, {r.reasons}")
    if result.incomplete:
        gaps = validate.histogram(df, by).groupBy("instrument_name").agg(F.sort_array(F.collect_list(F.struct("bucket", "missing"))).alias("parts"))
        for r in gaps.orderBy("instrument_name").limit(shown).collect():
            lines.append(f"{r.instrument_name}: missing by tenth " + " ".join(str(p.missing) for p in r.parts))
    lines.append(f"{result.n_rows:,} rows, {totals.first_day} to {totals.last_day} UTC, {Files(df.sparkSession).size(path):,} bytes")
    lines.append(f"{result.complete:,} complete, {result.incomplete:,} incomplete, {result.unknown:,} unknown")
    return lines, result


def validate_parquet(spark: SparkSession, path: str | os.PathLike, *, checkpoint_path: str | os.PathLike | None = None, data_type: str | None = None) -> tuple[DataFrame, validate.Result]:
    """The verdicts over a compacted dataset, against a ledger if one is named.

    ``checkpoint_path`` and ``data_type`` come together or not at all; a dataset or ledger that is not there raises.
    """
    if (checkpoint_path is None) != (data_type is None):
        raise ValueError("checkpoint_path and data_type must be given together")
    if not Files(spark).exists(path):
        raise FileNotFoundError(f"no dataset at {path}")
    bounds = None if checkpoint_path is None else checkpoint.targets(spark, checkpoint_path, data_type)
    return validate.validate(spark.read.parquet(os.fspath(path)), bounds)


def matrix(cores: int) -> list[dict[str, object]]:
    """The cases of a compaction benchmark: partitions up to the cores, deduplication off, the fast codec."""
    base = {"partitions": min(4, cores), "deduplicate": True, "fast": False}
    cases = [base | {"name": f"partitions {n}", "partitions": n} for n in (1, 2, 4, 8) if n <= cores]
    return [*cases, base | {"name": "no dedup", "deduplicate": False}, base | {"name": "lz4", "fast": True}]


def markdown(rows: Iterable[Mapping[str, object]]) -> str:
    """A table of rows that have the same keys."""
    rows = list(rows)
    if not rows:
        return ""
    names = list(rows[0])
    cell = lambda v: f"{v:,.1f}" if isinstance(v, float) else f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else str(v)
    body = ["| " + " | ".join(cell(r[n]) for n in names) + " |" for r in rows]
    return "\n".join(["| " + " | ".join(names) + " |", "|" + "-|" * len(names), *body]) + "\n"
