import pytest

from tallyline.operators import ledger, stats, validate
from tallyline.plans import planning
from tallyline.schema import FUTURE_CHUNK, FUTURE_META, OPTION_META, TARGET

N = 10_000


def chunks(spark, rows):
    return spark.createDataFrame([("F", *r) for r in rows], FUTURE_CHUNK)


@pytest.mark.parametrize(
    ("row", "expired", "done"),
    [((1, N, 0, 0), 0, 1), ((1, N, 1, 0), 0, 0), ((1, 5000, 1, 0), 0, 0), ((5, 350, 0, 0), 1, 1), ((10001, 5000, 0, 0), 0, 0), ((1, 0, None, 0), 1, 0), ((1, 0, None, 1), 0, 1)],
)
def test_finalize_chunks(spark, row, expired, done):
    meta = spark.createDataFrame([("F", expired, 0)], FUTURE_META)
    assert ledger.finalize_chunks(chunks(spark, [row]), meta, N).first().is_done == done


def test_growing_tail_stays_pending(spark):
    meta = spark.createDataFrame([("F", 0, 0)], FUTURE_META)
    held = ledger.finalize_chunks(chunks(spark, [(1, N, 0, 0), (10001, 5000, 0, 0)]), meta, N)
    planned = planning.chunk_plan(spark.createDataFrame([("F", 25000)], "instrument string, last_seq long"), N)
    held = ledger.insert_chunks(held, planned)
    assert sorted(r.chunk_no for r in ledger.pending(held).collect()) == [10001, 20001]
    again = ledger.insert_chunks(held, planned)
    assert again.count() == 3


def test_finalize_meta(spark):
    meta = spark.createDataFrame([("done", 1, 0), ("active", 0, 0), ("open", 1, 0), ("none", 1, 0), ("was", 0, 1)], FUTURE_META)
    rows = [("done", 1, N, 0, 1), ("active", 1, N, 0, 1), ("open", 1, N, 0, 1), ("open", 10001, 5, 1, 0)]
    got = {r.instrument: r.is_completed for r in ledger.finalize_meta(meta, spark.createDataFrame(rows, FUTURE_CHUNK)).collect()}
    assert got == {"done": 1, "active": 0, "open": 0, "none": 0, "was": 1}


def test_upsert_update_and_offsets(spark):
    meta = spark.createDataFrame([("a", 100, 0, 1), ("b", 7, 0, 0)], OPTION_META)
    listed = spark.createDataFrame([("a", 1), ("c", 0), ("c", 1)], "instrument string, is_expired int")
    got = {r.instrument: tuple(r)[1:] for r in ledger.upsert(meta, listed).collect()}
    assert got == {"a": (100, 1, 1), "b": (7, 0, 0), "c": (0, 1, 0)}
    for new, want in ((50, 100), (200, 200)):
        moved = ledger.advance(meta, spark.createDataFrame([("a", new)], "instrument string, last_no long"))
        assert {r.instrument: r.last_no for r in moved.collect()} == {"a": want, "b": 7}
    done = ledger.mark_complete(meta, spark.createDataFrame([("b",)], "instrument string"))
    assert ledger.incomplete(done).count() == 0
    seen = spark.createDataFrame([("F", 1, 9, 0)], "instrument string, chunk_no long, count long, has_more int")
    got = sorted(map(tuple, ledger.update_chunks(chunks(spark, [(1, 3, 1, 0), (11, 4, 1, 0)]), seen).collect()))
    assert got == [("F", 1, 9, 0, 0), ("F", 11, 4, 1, 0)]


def test_targets(spark):
    meta = spark.createDataFrame([("a", 1, 1), ("b", 1, 0)], FUTURE_META)
    rows = [("a", 1, N, 0, 1), ("a", 10001, 50, 0, 1), ("a", 20001, 9, 0, 0), ("a", 30001, 0, 0, 1)]
    got = {r.instrument_name: (r.max_seq, r.is_complete) for r in ledger.future_targets(meta, spark.createDataFrame(rows, FUTURE_CHUNK)).collect()}
    assert got == {"a": (10050, True), "b": (0, False)}


def verdicts(spark, rows, targets):
    df = spark.createDataFrame([(i, s, 1_700_000_000_000) for i, seqs in rows.items() for s in seqs], "instrument_name string, trade_seq long, timestamp long")
    bounds = spark.createDataFrame([(i, *t) for i, t in targets.items()], TARGET)
    details, result = validate.validate(df, bounds)
    return {r.instrument_name: (r.status, r.reasons) for r in details.collect()}, result


def test_every_rule(spark):
    rows = {"ok": [1, 2, 3], "dup": [1, 1, 3], "head": [2, 3], "tail": [1], "over": [1, 2, 3, 4], "extra": [1], "open": [1, 2, 3], "free": [1, 2]}
    targets = {"ok": (3, True), "dup": (3, True), "head": (3, True), "tail": (3, True), "over": (3, True), "extra": (0, True), "open": (3, False), "gone": (2, True), "empty": (0, True), "later": (0, False)}
    got, result = verdicts(spark, rows, targets)
    assert got == {
        "ok": ("COMPLETE", "checkpoint range matched"),
        "dup": ("INCOMPLETE", "1 duplicates; 1 internal gaps"),
        "head": ("INCOMPLETE", "missing head"),
        "tail": ("INCOMPLETE", "missing known tail through 3"),
        "over": ("INCOMPLETE", "rows beyond final checkpoint 3"),
        "extra": ("INCOMPLETE", "checkpoint expects no rows"),
        "open": ("UNKNOWN", "checkpoint upper bound is not final"),
        "free": ("UNKNOWN", "no checkpoint target"),
        "gone": ("INCOMPLETE", "missing head; missing known tail through 2"),
        "empty": ("COMPLETE", "checkpoint range matched"),
        "later": ("UNKNOWN", "checkpoint upper bound is not final"),
    }
    assert (result.complete, result.incomplete, result.unknown, result.exit_code) == (2, 6, 3, 1)
    assert verdicts(spark, {"open": [1]}, {"open": (1, False)})[1].exit_code == 2
    assert verdicts(spark, {"ok": [1]}, {"ok": (1, True)})[1].exit_code == 0


@pytest.mark.parametrize(("seqs", "missing"), [([*range(1, 21), *range(31, 101)], [0, 0, 10, 0, 0, 0, 0, 0, 0, 0]), ([*range(1, 46), *range(56, 101)], [0, 0, 0, 0, 5, 5, 0, 0, 0, 0])])
def test_histogram(spark, seqs, missing):
    df = spark.createDataFrame([("A", s, 0) for s in seqs * 2] + [("B", s, 0) for s in (1, 2)], "instrument_name string, trade_seq long, timestamp long")
    for mode in ("compat", "exact"):
        got = validate.histogram(df, stats.by_key(df), mode).orderBy("bucket").collect()
        assert [r.missing for r in got] == missing and {r.instrument_name for r in got} == {"A"}
    with pytest.raises(ValueError):
        validate.histogram(df, stats.by_key(df), "other")


def test_histogram_of_a_remainder(spark):
    seqs = [s for s in range(1, 104) if s != 50]
    df = spark.createDataFrame([("A", s, 0) for s in seqs], "instrument_name string, trade_seq long, timestamp long")
    both = {m: [r.missing for r in validate.histogram(df, stats.by_key(df), m).orderBy("bucket").collect()] for m in ("compat", "exact")}
    assert both["exact"] == [0, 0, 0, 0, 1, 0, 0, 0, 0, 0]
    assert sum(both["compat"]) == 1 and both["compat"] != both["exact"]
    far = spark.createDataFrame([("A", s, 0) for s in (1, 5000, 5001, 50000, 50001)], "instrument_name string, trade_seq long, timestamp long")
    assert [r.found for r in validate.histogram(far, stats.by_key(far)).orderBy("bucket").collect()] == [2 + 1, 0, 0, 0, 0, 0, 0, 0, 0, 2]


def test_planning(spark):
    bounds = spark.createDataFrame([("none", None), ("zero", 0), ("some", 25000)], "instrument string, last_seq long")
    assert sorted(map(tuple, planning.chunk_plan(bounds, N).collect())) == [("some", 1, 10000), ("some", 10001, 20000), ("some", 20001, 25000)]
    listed = spark.createDataFrame([(x,) for x in ("none", "zero", "some", "absent")], "instrument string")
    states = planning.triaged(listed, bounds)
    assert {r.instrument: r.state for r in states.collect()} == {"none": "unknown", "absent": "unknown", "zero": "empty", "some": "plan"}
    for expired, want in ((1, ["zero"]), (0, [])):
        meta = spark.createDataFrame([("zero", expired, 0)], FUTURE_META)
        assert [r.instrument for r in planning.confirmed_empty(states, meta).collect()] == want
    open_ = spark.createDataFrame([("none", 1), ("some", 20001), ("some", 30001)], "instrument string, chunk_no long")
    assert sorted(map(tuple, planning.bounded_pending(open_, bounds, N).collect())) == [("some", 20001, 25000)]
    assert [r.instrument for r in planning.unbounded(open_, bounds).collect()] == ["none"]


def test_coverage_and_cursor(spark):
    rows = [("A", 1, 3, s) for s in (3, 1, 2)] + [("B", 1, 3, s) for s in (1, 2, 2, 4)] + [("C", 1, 3, None)]
    got = {r.instrument: (r.received, r.covered, r.proved) for r in planning.coverage(spark.createDataFrame(rows, "instrument string, start long, end long, seq long")).collect()}
    assert got == {"A": (3, 3, True), "B": (4, 2, False), "C": (0, 0, False)}
    asked = spark.createDataFrame([("full", 1, False, True), ("more", 1, True, True), ("short", 1, False, True), ("active", 1, False, False), ("nothing", 7, False, True)], "instrument string, start long, has_more boolean, is_expired boolean")
    pages = spark.createDataFrame([("full", s) for s in (1, 2, 3)] + [("more", 42), ("short", 90), ("short", 100), ("active", 95)], "instrument string, seq long")
    got = {r.instrument: (r.next_seq, r["continues"], r.finished) for r in planning.cursor(pages, asked, 3).collect()}
    assert got == {"full": (4, True, False), "more": (43, True, False), "short": (101, False, True), "active": (96, False, False), "nothing": (8, False, True)}
