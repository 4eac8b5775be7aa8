"""Compaction benchmark: synthetic records, a matrix of cases, seconds, rates and peak memory; as JSON and Markdown."""

from __future__ import annotations

import json
import os
import platform
import threading
import time
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession

from tallyline import reports
from tallyline.functions import synthetic
from tallyline.sources import compacted, raw
from tallyline.sources.files import Files


def _resident(pid: int) -> int:
    """Bytes of memory of a process and all below it; 0 where there is no /proc."""
    total, todo = 0, [pid]
    while todo:
        at = todo.pop()
        try:
            total += int(Path(f"/proc/{at}/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE")
            for task in os.listdir(f"/proc/{at}/task"):
                todo += map(int, Path(f"/proc/{at}/task/{task}/children").read_text().split())
        except (OSError, IndexError, ValueError):
            continue
    return total


@dataclass
class Peak:
    """The most memory that this process, its JVM and its workers have together, while it is entered."""

    every: float = 0.2
    mb: float = 0.0
    _done: threading.Event = field(default_factory=threading.Event, repr=False)

    def __enter__(self) -> Peak:
        self._done.clear()
        self._thread = threading.Thread(target=self._watch, daemon=True)
        self._thread.start()
        return self

    def _watch(self) -> None:
        while True:
            self.mb = max(self.mb, round(_resident(os.getpid()) / 1e6, 1))
            if self._done.wait(self.every):
                return

    def __exit__(self, *_) -> None:
        self._done.set()
        self._thread.join()


@dataclass(frozen=True)
class Workload:
    """Keys with equally many records each, and one with more; a share of all is there twice."""

    keys: int = 200
    rows: int = 5000
    largest: int = 800_000
    repeated: float = 0.01
    files: int = 16

    @classmethod
    def quick(cls) -> Workload:
        return cls(20, 500, 40_000)

    def write(self, spark: SparkSession, folder: str) -> int:
        """Write the records as raw files; returns their bytes."""
        made = synthetic.trades(spark, self.keys, self.rows, self.largest, self.repeated)
        raw.append(made.repartition(self.files), folder)
        return sum(e.size for e in raw.checked_files(spark, folder))


def case(spark: SparkSession, source: str, target: str, size: int, *, name: str, **options) -> dict[str, object]:
    """One compaction: seconds, rates, ratio and peak memory."""
    began = time.perf_counter()
    with Peak() as peak:
        report = compacted.compact(spark, source, target, **options)
    took = time.perf_counter() - began
    written = Files(spark).size(target)
    return {
        "name": name, "seconds": round(took, 3), "rows_in": report.rows_in, "rows_out": report.rows_out, "rows_per_sec": round(report.rows_in / took), "mb_per_sec": round(size / 1e6 / took, 1),
        "ratio": round(size / max(written, 1), 1), "peak_mb": peak.mb,
    }


def run(spark: SparkSession, folder: str, workload: Workload, cores: int) -> list[dict[str, object]]:
    """Every case of the matrix over one workload, after one that is not counted."""
    source, target = f"{folder}/raw", f"{folder}/out.parquet"
    size = workload.write(spark, source)
    case(spark, source, target, size, name="warm-up")
    return [case(spark, source, target, size, **options) for options in reports.matrix(cores)]


def write(rows: list[dict[str, object]], folder: str | os.PathLike, workload: Workload) -> None:
    """``results.json`` and ``BENCHMARK.md``."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    about = {"workload": workload.__dict__, "cpus": os.cpu_count(), "python": platform.python_version(), "system": platform.system()}
    (folder / "results.json").write_text(json.dumps(about | {"cases": rows}, indent=1))
    said = ", ".join(f"{k} {v}" for k, v in workload.__dict__.items())
    (folder / "BENCHMARK.md").write_text(f"# Compaction\n\nWorkload: {said}. {os.cpu_count()} CPUs.\n\n{reports.markdown(rows)}")
