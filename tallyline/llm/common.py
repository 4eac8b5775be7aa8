"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources.files import Files


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The session's ``spark.checkpoint.dir``; where that is unset (tests), the
    context's checkpoint folder, or a new local one.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_SCRATCH: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{_SCRATCH[-1] if _SCRATCH else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to the shared folder in here goes at the end; so must what reads it have run."""
    path = shared_path(spark, "scratch")
    _SCRATCH.append(path)
    try:
        yield
    finally:
        _SCRATCH.remove(path)
        Files(spark).delete(path)


def relieve(spark: SparkSession, collect: bool = False) -> None:
    """Give memory that the driver's JVM has freed outside its heap back to the system; with ``collect``, its heap's garbage first.

    Compilers and compression allocate in many threads, and the C library keeps what they free: some 290 MB after a few
    hundred queries of the pipeline. JVMs without the command (before 17.0.9) keep it.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    if collect:
        jvm.System.gc()
    kinds, given = gateway.new_array(jvm.Class, 4), gateway.new_array(jvm.Object, 4)
    for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = jvm.Class.forName(kind)
    with contextlib.suppress(Py4JError):
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, given)


def unburden(spark: SparkSession, workers: bool = True) -> None:
    """Executors give back what the work before has left there: their JVMs' garbage, and what their Python workers keep.

    A heap that was once filled stays as large, and its JVM and workers share an executor's memory. A task for each core
    collects the heap, which shrinks it, and calls ``release``; idle cores get one each, and a busy one is left out.
    Without ``workers`` no Python runs, and they keep what they have.
    """
    cores = spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches
        release()

    done = spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("done"))
    (done.mapInArrow(run, "done string") if workers else done).collect()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    relieve(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``df``, which nothing reads any more; other frames have nothing to delete."""
    if path := getattr(df, "_written_to", None):
        Files(df.sparkSession).delete(path)


def input_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of the size of ``df``; nothing is run.

    Where it has none (rows from the driver or an RDD), 8 MB for each partition.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 8_000_000 * df.rdd.getNumPartitions()


def partitions_for(df: DataFrame, mb: float, least: int = 8) -> int:
    """Blocks that hold about ``mb`` each of the estimated size of ``df``; as many as that takes."""
    return max(least, math.ceil(input_bytes(df) / (mb * 1e6)))


#: Partitions of a shuffle; where blocks are more, a task has several, one after another.
MOST_PARTITIONS = 1 << 14
#: Blocks that are named so that each has a partition of its own; with more, a partition has several and they even out.
MOST_NAMED = 1 << 11


def block_names(n: int) -> list[int]:
    """``n`` integers of which a shuffle to ``n`` partitions puts one in each.

    Shuffles place a row by Spark's Murmur3 hash of its key; of numbers 0 to n - 1 some partitions would get several and
    many none.
    """
    left = lambda x, k: x << np.uint32(k) | x >> np.uint32(32 - k)
    names: dict[int, int] = {}
    start, step = 0, 4 * n + 64
    with np.errstate(over="ignore"):
        while len(names) < n:
            tried = np.arange(start, start + step, dtype=np.uint32)
            h = left(tried * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593) ^ np.uint32(42)
            h = left(h, 13) * np.uint32(5) + np.uint32(0xE6546B64) ^ np.uint32(4)
            for shift, times in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
                h = (h ^ h >> np.uint32(shift)) * np.uint32(times)
            for place, name in zip((h.view(np.int32).astype(np.int64) % n).tolist(), tried.tolist(), strict=True):
                names.setdefault(place, name)
            start += step
    return [names[k] for k in range(n)]


def deal(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with their ``block``, an integer, dealt out by it.

    A hash of id and text together, so that rows without an id, and those that repeat one, spread by their texts.
    """
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    if blocks <= MOST_NAMED:
        place = F.element_at(F.lit(block_names(blocks)), place + 1).cast("int")
    return docs.withColumn("block", place).repartition(min(blocks, MOST_PARTITIONS), "block")


def fresh_name(names) -> str:
    """A column name that none of ``names`` begins with, in whatever case."""
    name = "__text"
    while any(n.lower().startswith(name) for n in names):
        name += "_"
    return name


_KEPT: dict[str, tuple] = {}


def kept(owner: str, key: tuple, make):
    """``make()``, kept by this worker process until ``key`` differs or another operator works here."""
    release(owner)
    if owner not in _KEPT or _KEPT[owner][0] != key:
        _KEPT.pop(owner, None)
        _KEPT[owner] = key, make()
    return _KEPT[owner][1]


def release(owner: str = "") -> None:
    """Drop what other operators keep in this worker process, and give free memory back to the system."""
    for other in [k for k in _KEPT if k != owner]:
        del _KEPT[other]
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library
        trim(0)


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        start, held = 0, 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for k, n in enumerate(lengths):
            n = n or 0
            if k > start and held + n > limit:
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


def blank(column: str = "text"):
    """The column as a string in which null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Items of an array that are worked through together.
CHUNK = 128


def positions(items: Column, advance: Callable[[Column], Column], make: Callable[[Column, Column], Column], kind: str) -> Column:
    """For each of ``items`` what ``make(at, item)`` is, as an array of ``kind``; ``at`` is the sum of ``advance`` of the items before.

    Appending copies an array, so it is done in chunks: time grows with the items, not with their square.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(CHUNK))
    chunks = F.transform(starts, lambda k: F.slice(items, k + 1, F.lit(CHUNK)))
    state = lambda at, out, of: F.struct(at.cast("int").alias("at"), out.cast(of).alias("out"))

    def step(acc, x):
        return state(acc["at"] + advance(x), F.concat(acc["out"], F.array(make(acc["at"], x))), f"array<{kind}>")

    def chunk(acc, part):
        one = F.aggregate(part, state(acc["at"], F.array(), f"array<{kind}>"), step)
        return state(one["at"], F.concat(acc["out"], F.array(one["out"])), f"array<array<{kind}>>")

    return F.flatten(F.aggregate(chunks, state(F.lit(0), F.array(), f"array<array<{kind}>>"), chunk, lambda acc: acc["out"]))


#: Tasks that add up the vectors of all others, and so the most that the driver gets.
FAN = 16


def summed(vectors: DataFrame, size: int) -> np.ndarray:
    """The sum of the float64 vectors of ``size`` in the one binary column of ``vectors``.

    Each task hands on one vector; ``FAN`` tasks add those up, and the driver adds theirs,
    so what it gets is bounded by ``FAN * size`` numbers whatever the input.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    total = np.zeros(size)
    for row in vectors.toDF("v").repartition(FAN).mapInArrow(add, "v binary").collect():
        total += np.frombuffer(bytes(row.v), np.float64)
    return total
