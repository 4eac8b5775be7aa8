"""Session construction with the settings every operator relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "tallyline", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC, ANSI and adaptive execution.

    ``master`` is only set when given, so the same call works under spark-submit;
    extra ``conf`` entries use ``_`` for ``.``-free keys as plain strings.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def local_session(cores: int | None = None, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    n = cores or os.cpu_count() or 4
    settings = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
    } | conf
    return build_session("tallyline-local", f"local[{n}]", **settings)
