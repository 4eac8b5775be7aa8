"""Completeness of compacted records against a ledger, in three values.

COMPLETE is only said of a key whose final bound is known and whose sequences are
exactly those up to it; UNKNOWN where nothing is wrong but the bound is not known or
not final; INCOMPLETE with every reason otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators import stats as st
from tallyline.schema import KEY, SEQ, TIME

COMPLETE, INCOMPLETE, UNKNOWN = "COMPLETE", "INCOMPLETE", "UNKNOWN"
BUCKETS = 10


def detail(stats: DataFrame, targets: DataFrame | None, key: str = KEY) -> DataFrame:
    """A row for each key of either side: counts, bound, status and reasons, joined by ``"; "``."""
    if targets is None:
        joined = stats.withColumns({"max_seq": F.lit(None).cast("long"), "is_complete": F.lit(None).cast("boolean")})
    else:
        joined = stats.join(targets.select(F.col("instrument_name").alias(key), "max_seq", "is_complete"), key, "full_outer")
    rows, unique = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_rows", "n_unique"))
    low, high, bound = F.col("seq_min"), F.col("seq_max"), F.col("max_seq")
    gaps = high - low + 1 - unique
    bounded = F.coalesce(bound > 0, F.lit(False))
    text = lambda c: c.cast("long").cast("string")

    def reason(condition: Column, *words: Column | str) -> Column:
        said = F.concat(*(F.lit(w) if isinstance(w, str) else w for w in words))
        return F.when(F.coalesce(condition, F.lit(False)), said)

    reasons = F.concat_ws(
        "; ",
        reason(rows != unique, text(rows - unique), " duplicates"),
        reason((unique > 0) & (gaps > 0), text(gaps), " internal gaps"),
        reason(bounded & F.coalesce(low != 1, F.lit(True)), "missing head"),
        reason(bounded & F.coalesce(high < bound, F.lit(True)), "missing known tail through ", text(bound)),
        reason(bounded & F.col("is_complete") & (high > bound), "rows beyond final checkpoint ", text(bound)),
        reason((bound == 0) & (rows > 0), "checkpoint expects no rows"),
    )
    out = joined.select(key, rows.alias("n_rows"), unique.alias("n_unique"), "seq_min", "seq_max", "max_seq", "is_complete", F.coalesce(gaps, F.lit(0)).alias("gaps"), reasons.alias("why"))
    wrong = F.col("why") != ""
    status = F.when(wrong, F.lit(INCOMPLETE)).when(F.coalesce("is_complete", F.lit(False)), F.lit(COMPLETE)).otherwise(F.lit(UNKNOWN))
    final = F.when(wrong, F.col("why")).when(F.col("is_complete").isNull(), F.lit("no checkpoint target")).when(~F.col("is_complete"), F.lit("checkpoint upper bound is not final")).otherwise(F.lit("checkpoint range matched"))
    return out.select(*(c for c in out.columns if c != "why"), status.alias("status"), final.alias("reasons"))


def summary(details: DataFrame) -> DataFrame:
    """One row: how many keys have each status, and the rows of all."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s.lower())
    return details.agg(count(COMPLETE), count(INCOMPLETE), count(UNKNOWN), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))


def exit_code(summaries: DataFrame) -> DataFrame:
    """One row: 1 if anything is incomplete, else 2 if anything is unknown, else 0. Several kinds may be unioned."""
    bad, open_ = F.coalesce(F.sum("incomplete"), F.lit(0)), F.coalesce(F.sum("unknown"), F.lit(0))
    return summaries.agg(F.when(bad > 0, F.lit(1)).when(open_ > 0, F.lit(2)).otherwise(F.lit(0)).alias("exit_code"))


def histogram(df: DataFrame, stats: DataFrame | None = None, expected: str = "compat", key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Of every key with internal gaps, for ten equal parts of its range: sequences there, expected and missing.

    ``compat`` expects one more in the first ``total % 10`` parts, as reports have it;
    ``exact`` expects what the assignment of sequences to parts gives. All keys in one pass: without
    ``stats`` they come from the same distinct pairs that are counted, by one scan and one exchange of those.
    """
    pairs = df.groupBy(key, F.col(seq).cast("long").alias("__seq")).agg(F.count("*").alias("n"))
    if stats is None:
        stats = pairs.groupBy(key).agg(F.count("*").alias("n_unique"), F.min("__seq").alias("seq_min"), F.max("__seq").alias("seq_max"))
    gapped = stats.where((F.col("n_unique") > 0) & (F.col("seq_max") - F.col("seq_min") + 1 > F.col("n_unique")))
    gapped = gapped.select(key, F.col("seq_min").alias("low"), (F.col("seq_max") - F.col("seq_min") + 1).alias("total"))
    own = pairs.select(key, "__seq").join(gapped, key)
    # A null sequence is in no part; a filter on it would go below the grouping and part the two uses of it.
    part = F.when(F.col("__seq").isNull(), F.lit(-1)).otherwise(F.least(F.greatest(F.expr(f"(__seq - low) * {BUCKETS} div total"), F.lit(0)), F.lit(BUCKETS - 1))).cast("int")
    counts = own.select(key, part.alias("bucket")).groupBy(key, "bucket").agg(F.count("*").alias("found"))
    spine = gapped.select(key, "total", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("bucket"))
    if expected == "compat":
        want = F.expr(f"total div {BUCKETS}") + (F.col("bucket") < F.col("total") % BUCKETS).cast("long")
    elif expected == "exact":
        ceil = lambda b: F.expr(f"(({b}) * total + {BUCKETS - 1}) div {BUCKETS}")
        want = ceil("bucket + 1") - ceil("bucket")
    else:
        raise ValueError(f"expected must be compat or exact, not {expected!r}")
    joined = spine.join(counts, [key, "bucket"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return joined.select(key, "bucket", "found", want.cast("long").alias("expected")).withColumn("missing", F.col("expected") - F.col("found"))


@dataclass(frozen=True)
class Result:
    """Totals of a validation, for a caller or a shell."""

    complete: int
    incomplete: int
    unknown: int
    n_rows: int

    @property
    def exit_code(self) -> int:
        return 1 if self.incomplete else 2 if self.unknown else 0


def validate(df: DataFrame, targets: DataFrame | None = None) -> tuple[DataFrame, Result]:
    """The detail of every key, and the totals."""
    return validate_stats(st.by_key(df, KEY, SEQ, TIME), targets)


def validate_stats(stats: DataFrame, targets: DataFrame | None = None) -> tuple[DataFrame, Result]:
    """As ``validate``, from the statistics of each key."""
    details = detail(stats, targets)
    row = summary(details).first()
    return details, Result(row.complete, row.incomplete, row.unknown, row.n_rows)
