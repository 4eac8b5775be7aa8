"""Projections and filters over sequenced records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schema import RECORD, SEQ


def canonical(df: DataFrame, names: Mapping[str, str | Column] | None = None, schema: T.StructType = RECORD) -> DataFrame:
    """``df`` in exactly the fields of ``schema``: cast where given, typed nulls elsewhere.

    ``names`` maps a field to the column or expression that has it; by default, the column of its name.
    """
    names = {f.name: f.name for f in schema if f.name in df.columns} if names is None else names

    def one(f: T.StructField) -> Column:
        found = names.get(f.name)
        source = F.lit(None) if found is None else F.col(found) if isinstance(found, str) else found
        return source.cast(f.dataType).alias(f.name)

    return df.select(*map(one, schema))


def above(df: DataFrame, bound: int, seq: str = SEQ) -> DataFrame:
    """Rows past a high-water mark. Only ascending input may be deduplicated this way."""
    return df.where(F.col(seq).cast("long") > F.lit(bound))


def within(df: DataFrame, start: str | int, end: str | int, seq: str = SEQ) -> DataFrame:
    """Rows whose sequence is in the closed range; drops what a source leaks at its bounds."""
    side = lambda x: F.col(x) if isinstance(x, str) else F.lit(x)
    return df.where(F.col(seq).cast("long").between(side(start), side(end)))


#: Seen sequences up to which a list in the filter beats a join.
IN_LIST = 1000


def unseen(df: DataFrame, seen: DataFrame | Iterable[int] | None, seq: str = SEQ) -> DataFrame:
    """Rows whose sequence is not in ``seen``, which names sequences only; none or empty changes nothing."""
    if seen is None:
        return df
    if not isinstance(seen, DataFrame):
        held = sorted(set(seen))
        if not held:
            return df
        if len(held) <= IN_LIST:
            return df.where(~F.col(seq).cast("long").isin(held))
        seen = df.sparkSession.createDataFrame([(x,) for x in held], f"{seq} long")
    found = seen.select(F.col(seq).cast("long").alias("__seen")).distinct()
    return df.join(found, F.col(seq).cast("long") == F.col("__seen"), "left_anti")


def triage(df: DataFrame, last_seq: str = "last_seq") -> Column:
    """What a confirmed bound says: ``unknown`` where it is null, never zero; ``empty``; or ``plan``."""
    c = F.col(last_seq)
    return F.when(c.isNull(), F.lit("unknown")).when(c == 0, F.lit("empty")).otherwise(F.lit("plan"))


def retryable(status: Column) -> Column:
    """Whether an HTTP status may be tried again; null is a transport error, which may."""
    return F.coalesce(status.isin(408, 429) | (status >= 500), F.lit(True))
