import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import dedup, projection, stats


def frame(spark, rows):
    return spark.createDataFrame(rows, "instrument_name string, trade_seq long, at int")


def numbered(pairs):
    return [(i, s, k) for k, (i, s) in enumerate(pairs)]


@pytest.mark.parametrize("pairs", [[], [("A", 1)], [("A", x) for x in (1, 2, 2, 3, 3, 3)], [("A", 1), ("A", 1), ("A", 2), ("B", 1), ("B", 2)], [("A", x) for x in (5, 4, 3, 2, 1)], [("A", x) for x in (10, 3, 8, 2, 10, 7, 3)]])
def test_first_wins_whatever_the_order(spark, pairs):
    rows = numbered(pairs)
    want = {}
    for i, s, k in rows:
        want.setdefault((i, s), k)
    for function in (dedup.first_wins, dedup.first_wins_window):
        got = {(r.instrument_name, r.trade_seq): r.at for r in function(frame(spark, rows).repartition(3), ["at"]).collect()}
        assert got == want
    assert dedup.any_wins(frame(spark, rows)).count() == len(want)


def test_random_rows_against_a_set(spark):
    rng = random.Random(11)
    rows = numbered([(rng.choice("ABC"), rng.randrange(300)) for _ in range(3000)])
    rng.shuffle(rows)
    df = frame(spark, rows)
    unique = {(i, s) for i, s, _ in rows}
    assert dedup.first_wins(df, ["at"]).count() == len(unique)
    counted = {r.instrument_name: r.n_unique for r in dedup.bitmap_count(df).collect()}
    assert counted == {k: len({s for i, s in unique if i == k}) for k in "ABC"}
    assert dedup.accounting(df).agg(F.sum("removed")).first()[0] == len(rows) - len(unique)


def test_bitmaps_hold_wide_sequences(spark):
    seqs = [0, 1, 50, 100, 100, 32767, 32768, 32769, 295_692_526]
    got = dedup.bitmap_count(frame(spark, numbered([("A", s) for s in seqs]))).first()
    assert got.n_unique == len(set(seqs))


@pytest.mark.parametrize("row", [(None, 1, 0), ("A", None, 0), ("A", -1, 0)])
def test_guard_fails_on_bad_keys(spark, row):
    with pytest.raises(Exception, match="invalid key"):
        dedup.first_wins(dedup.guarded(frame(spark, [("A", 1, 0), row])), ["at"]).collect()
    assert dedup.guarded(frame(spark, [("A", 0, 0)])).count() == 1


def test_batches_in_order_of_arrival(spark):
    rows = [("A", s, b) for b, batch in enumerate([[10, 3, 8], [2, 10, 7, 3], [5, 4], [3, 2, 1]]) for s in batch]
    got = {r["at"]: (r.rows_in, r.rows_out, r.removed) for r in dedup.batches(frame(spark, rows), "at").collect()}
    assert got == {0: (3, 3, 0), 1: (4, 2, 2), 2: (2, 2, 0), 3: (3, 1, 2)}


def test_filters(spark):
    df = frame(spark, numbered([("A", s) for s in (3, 5, 7, 10)]))
    seqs = lambda d: sorted(r.trade_seq for r in d.collect())
    assert seqs(projection.above(df, 5)) == [7, 10]
    assert seqs(projection.within(df, 5, 7)) == [5, 7]
    assert seqs(projection.unseen(df, None)) == seqs(projection.unseen(df, [])) == [3, 5, 7, 10]
    assert seqs(projection.unseen(df, {3, 7})) == seqs(projection.unseen(df, df.where("trade_seq in (3, 7)"))) == [5, 10]
    assert seqs(projection.unseen(df, range(4, 4000))) == [3]


def test_stats_count_null_as_a_value(spark):
    df = frame(spark, [("A", 1, 5), ("A", 1, 6), ("A", 4, 7), ("B", None, 1)]).withColumn("timestamp", F.col("at").cast("long"))
    got = {r.instrument_name: tuple(r)[1:] for r in stats.by_key(df).collect()}
    assert got == {"A": (3, 2, 1, 4, 5, 7), "B": (1, 1, None, None, 1, 1)}
    total = stats.totals(stats.by_key(df)).first()
    assert (total.n_rows, total.n_keys, total.first_day) == (4, 2, "1970-01-01")


def test_canonical_fills_with_typed_nulls(spark):
    from tallyline.schema import RECORD

    got = projection.canonical(frame(spark, [("A", 1, 0)]))
    assert got.columns == [f.name for f in RECORD] and [f.dataType for f in got.schema] == [f.dataType for f in RECORD]
    assert got.first().price is None and got.first().trade_seq == 1
