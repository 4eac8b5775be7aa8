"""Plans of what to fetch: chunks of sequence ranges, bounded by what a source confirmed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.projection import triage


def chunk_plan(bounds: DataFrame, chunk_size: int) -> DataFrame:
    """(instrument, chunk_no, end_seq) for ``bounds`` (instrument, last_seq): closed ranges of ``chunk_size`` from 1.

    Nothing is planned where the bound is null or zero.
    """
    known = bounds.where("last_seq > 0")
    starts = known.select("instrument", "last_seq", F.explode(F.sequence(F.lit(1).cast("long"), F.col("last_seq").cast("long"), F.lit(chunk_size).cast("long"))).alias("chunk_no"))
    return starts.select("instrument", "chunk_no", F.least(F.col("chunk_no") + chunk_size - 1, F.col("last_seq").cast("long")).alias("end_seq"))


def bounded_pending(pending: DataFrame, bounds: DataFrame, chunk_size: int) -> DataFrame:
    """Pending chunks with the end of their range; those of an unknown bound are not scheduled."""
    joined = pending.select("instrument", "chunk_no").join(bounds.where("last_seq > 0"), "instrument")
    return joined.where("chunk_no <= last_seq").select("instrument", "chunk_no", F.least(F.col("chunk_no") + chunk_size - 1, F.col("last_seq").cast("long")).alias("end_seq"))


def unbounded(pending: DataFrame, bounds: DataFrame) -> DataFrame:
    """Instruments with pending chunks whose bound is not known: to be reported, and left pending."""
    return pending.select("instrument").distinct().join(bounds.where("last_seq > 0"), "instrument", "left_anti")


def triaged(listed: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every instrument of ``listed`` with its bound and what follows from it; an absent bound is unknown."""
    joined = listed.join(bounds, "instrument", "left")
    return joined.select("instrument", "last_seq", triage(joined).alias("state"))


def confirmed_empty(states: DataFrame, meta: DataFrame) -> DataFrame:
    """Expired instruments that a source says have no records: complete. An active one may still get some."""
    return states.where("state = 'empty'").join(meta.where("is_expired = 1"), "instrument", "left_semi").select("instrument")


def coverage(responses: DataFrame) -> DataFrame:
    """Whether rows (instrument, start, end, seq) of each asked range cover it: the distinct sequences inside equal its width.

    The only proof of a range; neither order nor a has-more flag proves anything.
    """
    inside = F.when(F.col("seq").between(F.col("start"), F.col("end")), F.col("seq"))
    each = responses.groupBy("instrument", "start", "end").agg(F.count_distinct(inside).alias("covered"), F.count("seq").alias("received"))
    width = F.col("end") - F.col("start") + 1
    return each.select("instrument", "start", "end", "received", "covered", width.alias("width"), (F.col("covered") == width).alias("proved"))


def cursor(pages: DataFrame, asked: DataFrame, chunk_size: int) -> DataFrame:
    """The next step of each cursor: ``asked`` (instrument, start, has_more, is_expired) and rows ``pages`` (instrument, seq).

    next_seq follows the largest sequence, or the start where nothing came; a full page or
    a has-more flag continues; a short last page finishes an expired instrument.
    """
    got = pages.groupBy("instrument").agg(F.max("seq").alias("top"), F.count("*").alias("n"))
    joined = asked.join(got, "instrument", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    more = (F.col("n") > 0) & (F.col("has_more") | (F.col("n") >= chunk_size))
    follow = F.when(F.col("n") > 0, F.col("top") + 1).otherwise(F.col("start") + 1)
    return joined.select("instrument", "n", follow.cast("long").alias("next_seq"), more.alias("continues"), (~more & F.col("is_expired")).alias("finished"))
