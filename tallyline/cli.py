"""Command line: ``python -m tallyline.cli compact|validate|ingest``."""

from __future__ import annotations

import argparse
import os
import signal
import sys
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from tallyline import benchmark, reports
from tallyline.config import Settings
from tallyline.schema import KINDS
from tallyline.session import build_session
from tallyline.sources import checkpoint, compacted
from tallyline.sources.files import Files
from tallyline.sources.history import driver_history
from tallyline.streaming import ingest


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyline")
    sub = top.add_subparsers(dest="command", required=True)
    one = sub.add_parser("compact", help="deduplicate raw files into one Parquet dataset")
    one.add_argument("--type", choices=KINDS, required=True)
    one.add_argument("--no-dedup", action="store_true")
    one.add_argument("--fast", action="store_true", help="lz4 in place of zstd")
    one.add_argument("--partitions", type=int)
    one.add_argument("--large-threshold-mb", type=float, default=100.0)
    one.add_argument("--block-mb", type=int, help="input that one task reads")
    one.add_argument("--batch-rows", type=int, help="rows of a batch of the columnar reader and writer")
    two = sub.add_parser("validate", help="exit 0 complete, 1 incomplete, 2 unknown")
    two.add_argument("--type", choices=(*KINDS, "both"), default="both")
    three = sub.add_parser("ingest", help="fetch what the ledger lacks")
    three.add_argument("--type", choices=KINDS, required=True)
    three.add_argument("--url", default="")
    three.add_argument("--transport", default="http", help="a registered transport, or module:factory")
    three.add_argument("--option", action="append", default=[], help="name=value, for the transport or the reader")
    three.add_argument("--batch", type=int, default=64, help="ranges between two looks at the ledger")
    three.add_argument("--readers", type=int, help="readers at a time; they share the request rate")
    for p in (one, two, three):
        p.add_argument("--base-dir")
    four = sub.add_parser("bench", help="compaction benchmark; writes results.json and BENCHMARK.md")
    four.add_argument("--out", required=True)
    four.add_argument("--quick", action="store_true")
    four.add_argument("--cores", type=int, default=os.cpu_count() or 1)
    four.add_argument("--work", help="folder for the records, which all executors see; default: under --out")
    return top


def run_validate(spark: SparkSession, settings: Settings, kind: str) -> int:
    kinds = KINDS if kind == "both" else (kind,)
    worst = 0
    for k in kinds:
        path = settings.compacted(k)
        lines, result = reports.validation(spark.read.parquet(str(path)), checkpoint.targets(spark, checkpoint.ledger_of(spark, settings.base_dir, k), k), path)
        print("\n".join(f"{k}: {line}" for line in lines))
        worst = 1 if 1 in (worst, result.exit_code) else max(worst, result.exit_code)
    return worst


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    reports.setup_logging()
    spark = spark or build_session(master=os.environ.get("SPARK_MASTER"))
    if args.command == "bench":
        workload = benchmark.Workload.quick() if args.quick else benchmark.Workload()
        work = f"{(args.work or args.out).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
        try:
            benchmark.write(benchmark.run(spark, work, workload, args.cores), args.out, workload)
        finally:
            Files(spark).delete(work)
        return 0
    settings = Settings.from_env().at(args.base_dir)
    if args.command == "compact":
        large = int(args.large_threshold_mb * (1 << 20))
        if args.block_mb:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(args.block_mb << 20))
        if args.batch_rows:
            spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(args.batch_rows))
        report = compacted.compact(spark, settings.raw_dir(args.type), settings.compacted(args.type), deduplicate=not args.no_dedup, fast=args.fast, large_file=large, partitions=args.partitions)
        print(f"{report.n_files} files: {report.rows_in:,} rows in, {report.rows_out:,} out, {report.removed:,} removed")
        return 0
    if args.command == "validate":
        return run_validate(spark, settings, args.type)
    stopped: list[int] = []
    for sign in (signal.SIGINT, signal.SIGTERM):
        signal.signal(sign, lambda number, _: stopped.append(number))
    options = {"url": args.url, "transport": args.transport, "chunk_size": str(settings.chunk_size), "max_rps": str(settings.max_rps), "readers": str(args.readers or settings.max_workers)} | ({"proxy": settings.proxy} if settings.proxy else {}) | dict(o.split("=", 1) for o in args.option)
    settings = replace(settings, chunk_size=int(options["chunk_size"]))
    landed = ingest.run(spark, args.type, settings, driver_history(options | {"readers": "1"}), options, batch=args.batch, stop=lambda: bool(stopped))
    print(f"{landed} ranges landed")
    return 0


if __name__ == "__main__":
    sys.exit(main())
