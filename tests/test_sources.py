import json
import os
from pathlib import Path

import pytest

from tallyline import cli, reports
from tallyline.config import Settings
from tallyline.functions import synthetic
from tallyline.operators import dedup
from tallyline.sources import checkpoint, compacted, raw
from tallyline.sources.history import ApiError, History, IncompleteRange, StatusError, TokenBucket, may_retry, wait_seconds
from tallyline.streaming import dedup as stream
from tallyline.streaming import ingest


def lines(folder, name, seqs, extra=""):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.jsonl").write_text("".join(json.dumps({"trade_seq": s, "instrument_name": name.split("-")[0], "timestamp": 1, "price": float(k), "other": 1}) + "\n" for k, s in enumerate(seqs)) + extra)


# ------------------------------------------------------------ compaction


@pytest.mark.parametrize(("seqs", "deduplicate", "want"), [([5, 4, 3, 2, 1], True, [1, 2, 3, 4, 5]), ([1, 1, 2], False, [1, 1, 2]), ([*range(50, 0, -1), 5, 10, 15], True, list(range(1, 51)))])
def test_compact(spark, tmp_path, seqs, deduplicate, want):
    lines(tmp_path / "raw", "A", seqs)
    (tmp_path / "raw" / "instruments.json").write_text("[{]")
    report = compacted.compact(spark, tmp_path / "raw", tmp_path / "out.parquet", deduplicate=deduplicate)
    assert sorted(r.trade_seq for r in spark.read.parquet(str(tmp_path / "out.parquet")).collect()) == want
    assert (report.rows_in, report.rows_out) == (len(seqs), len(want))


def test_large_files_then_names_then_positions_survive(spark, tmp_path):
    lines(tmp_path / "raw", "A-1", [1, 2, 2])
    lines(tmp_path / "raw", "A-2", [1, 3, 2] + list(range(10, 60)))
    got = lambda t: {r.trade_seq: r.price for r in compacted.survivors(spark, tmp_path / "raw", large_file=t).collect() if r.trade_seq < 4}
    assert got(1 << 30) == {1: 0.0, 2: 1.0, 3: 1.0}
    assert got(1000) == {1: 0.0, 2: 2.0, 3: 1.0}


@pytest.mark.parametrize("bad", ["not-json\n", '{"trade_seq": -1, "instrument_name": "A"}\n', '{"trade_seq": 1}\n'])
def test_failure_leaves_the_old_output(spark, tmp_path, bad):
    lines(tmp_path / "raw", "A", [3, 1])
    compacted.compact(spark, tmp_path / "raw", tmp_path / "out.parquet", fast=True)
    lines(tmp_path / "raw", "A", [3, 4], bad)
    with pytest.raises(Exception):  # noqa: B017
        compacted.compact(spark, tmp_path / "raw", tmp_path / "out.parquet")
    assert sorted(r.trade_seq for r in spark.read.parquet(str(tmp_path / "out.parquet")).collect()) == [1, 3]
    assert sorted(os.listdir(tmp_path)) == ["out.parquet", "raw"]


def test_nothing_to_compact(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        compacted.compact(spark, tmp_path / "none", tmp_path / "o")
    (tmp_path / "file").write_text("")
    with pytest.raises(NotADirectoryError):
        compacted.compact(spark, tmp_path / "file", tmp_path / "o")
    (tmp_path / "raw").mkdir()
    with pytest.raises(ValueError):
        compacted.compact(spark, tmp_path / "raw", tmp_path / "o")
    (tmp_path / "raw" / "A.jsonl").write_text("")
    with pytest.raises(ValueError):
        compacted.compact(spark, tmp_path / "raw", tmp_path / "o")
    assert not (tmp_path / "o").exists()


def test_blocks_cover_whole_lines(tmp_path):
    path = tmp_path / "f"
    for text in ("", "one\n", "one", "ab\n" * 50, "x" * 500 + "\ny\n"):
        path.write_text(text)
        blocks = raw.split_blocks(path, 20)
        assert "".join(text[a:b] for a, b in blocks) == text
        assert all(text[b - 1] == "\n" for _, b in blocks[:-1])


def test_synthetic_duplicates_are_removed(spark, tmp_path):
    made = synthetic.trades(spark, 5, 200, 1000, 0.1)
    assert made.count() > 2000 and dedup.any_wins(made).count() == 2000
    assert made.where("block_trade_id is not null").count() == 0
    assert made.exceptAll(synthetic.trades(spark, 5, 200, 1000, 0.1)).count() == 0
    lines(tmp_path / "raw", "A", [1, 2])
    row = raw.folder_stats(spark, tmp_path / "raw").first()
    assert (row.n_files, row.n_lines) == (1, 2) and row.n_bytes == (tmp_path / "raw" / "A.jsonl").stat().st_size


def test_streaming_dedup_over_restarts(spark, tmp_path):
    lines(tmp_path / "in", "A-1", [3, 1, 1, 2])
    for more in ([], [5, 3, 4], [1, 6]):
        if more:
            lines(tmp_path / "in", f"A-{more[0]}x", more)
        stream.run_available(stream.first_seen(stream.raw_stream(spark, tmp_path / "in", files_per_trigger=1)), tmp_path / "out", tmp_path / "state")
    assert sorted(r.trade_seq for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4, 5, 6]


# ------------------------------------------------------------ ledgers and shell


def test_snapshots_and_sqlite(spark, tmp_path):
    store = checkpoint.SnapshotStore(spark, tmp_path / "ledger")
    assert store.read("option_meta").count() == 0
    rows = spark.createDataFrame([("A", 3, 1, 1)], checkpoint.LEDGERS["option_meta"])
    store.commit(option_meta=rows)
    store.commit(future_meta=spark.createDataFrame([("F", 1, 0)], checkpoint.LEDGERS["future_meta"]))
    assert store.read("option_meta").first().last_no == 3 and store.read("future_meta").count() == 1
    for n in range(4):
        store.commit(option_meta=rows.selectExpr("instrument", f"{n}L as last_no", "is_expired", "is_completed"))
    assert store.read("option_meta").first().last_no == 3 and len([p for p in Path(tmp_path / "ledger").iterdir() if p.is_dir()]) == 4  # three versions of one table, one of the other
    checkpoint.write_sqlite(rows, tmp_path / "x.db", "option_meta")
    assert tuple(checkpoint.read_sqlite(spark, tmp_path / "x.db", "option_meta").first()) == ("A", 3, 1, 1)
    with pytest.raises(FileNotFoundError):
        checkpoint.read_sqlite(spark, tmp_path / "none.db", "option_meta")
    with pytest.raises(ValueError):
        checkpoint.targets(spark, tmp_path / "x.db", "spot")


@pytest.mark.parametrize(("seqs", "done", "code"), [([1, 2, 3], 1, 0), ([1, 3], 1, 1), ([1, 2, 3], 0, 2)])
def test_shell_codes(spark, tmp_path, seqs, done, code, capsys):
    lines(tmp_path / "option", "A", seqs)
    checkpoint.write_sqlite(spark.createDataFrame([("A", 3, 1, done)], checkpoint.LEDGERS["option_meta"]), tmp_path / "option.db", "option_meta")
    assert cli.main(["compact", "--type", "option", "--base-dir", str(tmp_path)], spark) == 0
    assert cli.main(["validate", "--type", "option", "--base-dir", str(tmp_path)], spark) == code
    said = capsys.readouterr().out
    assert ("missing by tenth" in said) == (code == 1)
    assert "1970-01-01 to 1970-01-01 UTC" in said


def test_markdown_and_matrix():
    assert reports.markdown([{"name": "a", "rows": 1234, "s": 1.25, "ok": True}]) == "| name | rows | s | ok |\n|-|-|-|-|\n| a | 1,234 | 1.2 | True |\n"
    assert reports.markdown([]) == "" and [c["name"] for c in reports.matrix(2)] == ["partitions 1", "partitions 2", "no dedup", "lz4"]


def test_benchmark_files(spark, tmp_path):
    assert cli.main(["bench", "--quick", "--out", str(tmp_path), "--cores", "2"], spark) == 0
    got = json.loads((tmp_path / "results.json").read_text())
    assert [c["name"] for c in got["cases"]] == ["partitions 1", "partitions 2", "no dedup", "lz4"] and all(c["seconds"] > 0 and c["peak_mb"] > 50 for c in got["cases"])
    assert {c["rows_out"] for c in got["cases"] if c["name"] != "no dedup"} == {50_000} and "| lz4 |" in (tmp_path / "BENCHMARK.md").read_text()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["BENCHMARK.md", "results.json"]


def test_settings():
    assert Settings.from_env({}).currency == Settings.from_env({"CURRENCY": "  "}).currency == "BTC"
    given = Settings.from_env({"CURRENCY": " ETH ", "https_proxy": "c", "HTTPS_PROXY": " b ", "http_proxy": "d"})
    assert (given.currency, given.proxy, given.raw_dir("option")) == ("ETH", "b", Path("data/ETH/option"))
    assert given.at("/x").compacted("future") == Path("/x/future.parquet") and given.at("") == given


# ------------------------------------------------------------ the history source


class Fake:
    """A deterministic source: pages may start late, leak past their range, come shuffled, or fail."""

    def __init__(self, sizes, expired=(), shift=0, leak=0, errors=(), holes=()):
        self.sizes, self.expired, self.shift, self.leak, self.errors, self.holes = sizes, set(expired), shift, leak, list(errors), set(holes)
        self.calls = []

    def request(self, method, params):
        self.calls.append((method, params))
        if self.errors:
            error = self.errors.pop(0)
            if isinstance(error, dict):
                return {"error": error}
            if error:
                raise error
        if method == "get_instruments":
            return {"result": [{"instrument_name": n, "is_active": n not in self.expired} for n in self.sizes if (n in self.expired) == params["expired"]]}
        name = params["instrument_name"]
        size = self.sizes[name]
        if size is None:
            raise StatusError(500)
        if "start_seq" not in params:
            return {"result": {"trades": [{"trade_seq": size}] if size else [], "has_more": False}}
        a, b = params["start_seq"], params["end_seq"]
        late = self.shift if b - a + 1 > 5 else 0
        seqs = [s for s in range(a + late, b + late + self.leak + 1) if s <= size and s not in self.holes]
        seqs = (seqs[1::2] + seqs[::2])[: params["count"] + self.leak]
        return {"result": {"trades": [{"trade_seq": s, "instrument_name": name, "timestamp": s, "price": 1} for s in seqs], "has_more": bool(seqs)}}


def fake_options(options):
    spec = json.loads(options["spec"])
    return Fake(spec["sizes"], spec.get("expired", ()), spec.get("shift", 0), spec.get("leak", 0), holes=spec.get("holes", ()))


def quiet(transport, **more):
    return History(transport, sleep=lambda s: None, **more)


def test_ranges_are_halved_until_whole():
    fake = Fake({"A": 100}, shift=2)
    got = quiet(fake).whole("A", 1, 10)
    assert sorted(r["trade_seq"] for r in got) == list(range(1, 11))
    assert [(p["start_seq"], p["end_seq"]) for _, p in fake.calls] == [(1, 10), (1, 5), (6, 10)]
    assert len(quiet(Fake({"A": 100}, leak=3)).whole("A", 1, 10)) == 10
    with pytest.raises(IncompleteRange, match="covered 0/3"):
        quiet(Fake({"A": 0})).whole("A", 1, 3)
    with pytest.raises(IncompleteRange):
        quiet(Fake({"A": 100}, holes=[7])).whole("A", 1, 64)
    with pytest.raises(IncompleteRange, match="after 4 requests"):
        quiet(Fake({"A": 1000}, shift=9)).whole("A", 1, 1000, budget=4)


def test_retries_and_bounds():
    waits = []
    history = History(Fake({"A": 5}, errors=[StatusError(429, "2"), StatusError(503), OSError()]), sleep=waits.append)
    assert history.last_seq("A") == 5 and waits[0] == 2.5 and all(1 <= w <= 60 for w in waits[1:])
    assert quiet(Fake({"A": 0})).last_seq("A") == 0 and quiet(Fake({"A": None}), attempts=2).last_seq("A") is None
    with pytest.raises(ApiError, match="source error 7"):
        quiet(Fake({"A": 5}, errors=[{"code": 7, "message": "no"}])).chunk("A", 1, 2)
    with pytest.raises(StatusError):
        quiet(Fake({"A": 5}, errors=[StatusError(404)])).chunk("A", 1, 2)
    assert [may_retry(StatusError(s)) for s in (408, 429, 500, 599, 400, 404)] == [True] * 4 + [False] * 2
    assert wait_seconds(StatusError(429, "soon"), 3, lambda a, b: b) == 8.0
    now, slept = [0.0], []
    bucket = TokenBucket(2, clock=lambda: now[0], sleep=slept.append)
    for _ in range(3):
        bucket.take()
    assert slept == [0.5, 1.0]


def settings_for(tmp_path, size=10):
    return Settings(base_dir=tmp_path, chunk_size=size)


def options_for(**spec):
    return {"transport": "tests.test_sources:fake_options", "spec": json.dumps(spec), "chunk_size": "10", "max_rps": "100000", "attempts": "1"}


def test_ingest_futures_to_a_verdict(spark, tmp_path):
    spec = {"sizes": {"OLD": 25, "NEW": 14, "EMPTY": 0, "QUIET": 0}, "expired": ["OLD", "EMPTY"], "shift": 1, "leak": 1}
    settings = settings_for(tmp_path)
    assert ingest.run(spark, "future", settings, quiet(fake_options({"spec": json.dumps(spec)}), page=10), options_for(**spec)) == 5
    store = checkpoint.SnapshotStore(spark, tmp_path / "future.ledger")
    meta = {r.instrument: r.is_completed for r in store.read("future_meta").collect()}
    assert meta == {"OLD": 1, "EMPTY": 1, "NEW": 0, "QUIET": 0}
    compacted.compact(spark, settings.raw_dir("future"), settings.compacted("future"))
    from tallyline.operators import ledger, validate

    details, result = validate.validate(spark.read.parquet(str(settings.compacted("future"))), ledger.future_targets(store.read("future_meta"), store.read("future_chunk")))
    got = {r.instrument_name: r.status for r in details.collect()}
    assert got == {"OLD": "COMPLETE", "EMPTY": "COMPLETE", "NEW": "UNKNOWN", "QUIET": "UNKNOWN"} and result.exit_code == 2
    spec["sizes"]["NEW"], spec["expired"] = 23, ["OLD", "EMPTY", "NEW"]
    assert ingest.run(spark, "future", settings, quiet(fake_options({"spec": json.dumps(spec)}), page=10), options_for(**spec)) == 2
    assert {r.instrument: r.is_completed for r in store.read("future_meta").collect()}["NEW"] == 1
    report = compacted.compact(spark, settings.raw_dir("future"), settings.compacted("future"))
    assert report.rows_out == 48 and report.rows_in == 52


def test_one_rate_over_all_ranges_of_a_process():
    """Every range of a reader asks through one bucket, on a clock that only waiting moves."""
    from tallyline.sources import history as h

    options = options_for(sizes={"A": 100}) | {"max_rps": "20", "readers": "4", "on_error": "fail", "ranges": json.dumps([["A", k * 10 + 1, k * 10 + 10] for k in range(10)])}
    now = [100.0]
    bucket = h.bucket_of(options)
    bucket.clock, bucket.sleep = lambda: now[0], lambda s: now.__setitem__(0, now[0] + s)
    reader = h.HistoryReader(options, h.RECORD)
    parts = reader.partitions()
    assert len(parts) == 4 and sorted(r for p in parts for r in p.ranges) == [("A", k * 10 + 1, k * 10 + 10) for k in range(10)]
    assert sum(1 for p in parts for _ in reader.read(p)) == 100
    assert now[0] - 100.0 == pytest.approx(9 / 5) and h.bucket_of(dict(options)) is bucket


def test_failures_carry_their_cause_and_others_are_raised():
    from tallyline.sources import history as h

    options = options_for(sizes={"A": 30, "B": None}, holes=[15]) | {"on_error": "report", "ranges": json.dumps([["A", 11, 20], ["A", 1, 5], ["B", 1, 3]])}
    reader = h.HistoryReader(options, h.RANGED)
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    errors = {r[-4:-1]: r[-1] for r in rows if r[-1]}
    assert set(errors) == {("A", 11, 20), ("B", 1, 3)} and errors["A", 11, 20].startswith("IncompleteRange") and errors["B", 1, 3] == "StatusError: HTTP status 500"
    assert [r[0] for r in rows if not r[-1]].__len__() == 5
    with pytest.raises(KeyError):
        [*reader.read(h.Ranges([("C", 1, 2)]))]


def test_http_transport(monkeypatch):
    """One connection for all requests of a thread; statuses and closed connections are errors that may be retried."""
    import http.server
    import pickle
    import threading

    from tallyline.sources import history as h

    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_GET(self):
            seen.append((self.path, self.client_address[1]))
            status = 429 if "busy" in self.path else 200
            body = json.dumps({"result": {"trades": [{"trade_seq": 7}], "has_more": False}}).encode()
            self.send_response(status)
            self.send_header("Retry-After", "3")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/api"
    transport = pickle.loads(pickle.dumps(h.HttpTransport(url)))
    assert History(transport).last_seq("A B") == 7 and transport.request("x", {"expired": True})["result"]["has_more"] is False
    assert [p for p, _ in seen] == ["/api/get_last_trades_by_instrument?instrument_name=A+B&count=1", "/api/x?expired=true"] and len({port for _, port in seen}) == 1
    with pytest.raises(StatusError) as caught:
        transport.request("busy", {})
    assert caught.value.status == 429 and wait_seconds(caught.value, 1) == 3.5
    through = h.HttpTransport("http://far.example.com/api", proxy=f"http://127.0.0.1:{server.server_port}")
    assert through.request("y", {})["result"]["trades"] and seen[-1][0] == "http://far.example.com/api/y?"
    transport.close()
    server.shutdown()
    server.server_close()
    with pytest.raises(OSError) as refused:
        transport.request("x", {})
    assert may_retry(refused.value)


def test_validation_of_a_path(spark, tmp_path):
    lines(tmp_path / "raw", "A", [1, 2, 3])
    compacted.compact(spark, tmp_path / "raw", tmp_path / "o.parquet")
    with pytest.raises(ValueError, match="together"):
        reports.validate_parquet(spark, tmp_path / "o.parquet", data_type="option")
    with pytest.raises(FileNotFoundError):
        reports.validate_parquet(spark, tmp_path / "none.parquet")
    with pytest.raises(FileNotFoundError):
        reports.validate_parquet(spark, tmp_path / "o.parquet", checkpoint_path=tmp_path / "no.db", data_type="option")
    assert reports.validate_parquet(spark, tmp_path / "o.parquet")[1].unknown == 1
    checkpoint.write_sqlite(spark.createDataFrame([("A", 3, 1, 1)], checkpoint.LEDGERS["option_meta"]), tmp_path / "x.db", "option_meta")
    assert reports.validate_parquet(spark, tmp_path / "o.parquet", checkpoint_path=tmp_path / "x.db", data_type="option")[1].exit_code == 0


def test_bounds_are_asked_for_side_by_side():
    sizes = {f"I{k}": k for k in range(50)} | {"X": None}
    assert dict(quiet(Fake(sizes), attempts=1).last_seqs([*sizes], 8)) == sizes


def test_ledger_deltas(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checkpoint, "MOST_DELTAS", 3)
    store = checkpoint.SnapshotStore(spark, tmp_path / "l")
    chunk = lambda *rows: spark.createDataFrame(rows, checkpoint.LEDGERS["future_chunk"])
    store.append(future_chunk=chunk(("A", 1, 0, None, 0), ("A", 11, 0, None, 0)))
    want = {("A", 1): 0, ("A", 11): 0}
    for n in range(8):
        store.append(future_chunk=chunk(("A", 1 + 10 * (n % 3), n + 1, 0, 0)))
        want["A", 1 + 10 * (n % 3)] = n + 1
        assert {(r.instrument, r.chunk_no): r["count"] for r in store.read("future_chunk").collect()} == want
    assert all(len(v["future_chunk"]) <= 3 for v in store._versions())


@pytest.mark.parametrize(("spec", "code"), [({"sizes": {"A": 25}, "expired": ["A"]}, 0), ({"sizes": {"A": 25}, "expired": ["A"], "holes": [15]}, 1), ({"sizes": {"A": 25}}, 2)])
def test_shell_from_ingest_to_verdict(spark, tmp_path, spec, code, capsys):
    """Ingest, compact and validate over one base folder, by the ledger that the ingest wrote."""
    base = ["--type", "option", "--base-dir", str(tmp_path)]
    options = [f"--option={k}={v}" for k, v in options_for(**spec).items() if k != "transport"]
    fetch = ["ingest", *base, "--transport", "tests.test_sources:fake_options", "--readers", "2", "--batch", "2", *options]
    if code == 1:
        with pytest.raises(ingest.FailedRanges, match="IncompleteRange"):
            cli.main(fetch, spark)
        # The ledger says how far it is proved; a final bound beyond what is there is a hole.
        store = checkpoint.SnapshotStore(spark, tmp_path / "option.ledger")
        store.commit(option_meta=store.read("option_meta").selectExpr("instrument", "25L as last_no", "is_expired", "1 as is_completed"))
    else:
        assert cli.main(fetch, spark) == 0 and "3 ranges landed" in capsys.readouterr().out
    assert cli.main(["compact", *base], spark) == 0
    assert cli.main(["validate", *base], spark) == code


def test_progress_and_stop(spark, tmp_path):
    spec, seen = {"sizes": {"A": 50}, "expired": ["A"]}, []
    settings, given = settings_for(tmp_path), {"batch": 2, "on_batch": seen.append, "stop": lambda: len(seen) == 2}
    assert ingest.run(spark, "option", settings, quiet(fake_options({"spec": json.dumps(spec)}), page=10), options_for(**spec), **given) == 4
    assert [(p.planned, p.landed, p.failed, p.records) for p in seen] == [(5, 2, 0, 20), (5, 4, 0, 40)] and "2 of 5 ranges" in str(seen[0])
    assert tuple(checkpoint.SnapshotStore(spark, tmp_path / "option.ledger").read("option_meta").first()) == ("A", 40, 1, 0)
    assert not [p for p in (tmp_path / "option").iterdir() if p.name.startswith(".batch")]


def test_failed_ranges_stay_pending(spark, tmp_path):
    spec = {"sizes": {"A": 30}, "expired": ["A"], "holes": [15]}
    settings = settings_for(tmp_path)
    with pytest.raises(ingest.FailedRanges, match=r"A \[11, 20\]"):
        ingest.run(spark, "option", settings, quiet(fake_options({"spec": json.dumps(spec)}), page=10), options_for(**spec))
    store = checkpoint.SnapshotStore(spark, tmp_path / "option.ledger")
    assert tuple(store.read("option_meta").first()) == ("A", 10, 1, 0)
    spec["holes"] = []
    assert ingest.run(spark, "option", settings, quiet(fake_options({"spec": json.dumps(spec)}), page=10), options_for(**spec)) == 2
    assert tuple(store.read("option_meta").first()) == ("A", 30, 1, 1)
    assert ingest.run(spark, "option", settings, quiet(fake_options({"spec": json.dumps(spec)}), page=10), options_for(**spec)) == 0


def test_stream_source(spark, tmp_path):
    from tallyline.sources.history import HistorySource

    spark.dataSource.register(HistorySource)
    for size, want in ((25, 25), (31, 31)):
        reader = spark.readStream.format("history").option("instrument", "A")
        for k, v in options_for(sizes={"A": size}, shift=1).items():
            reader = reader.option(k, v)
        query = reader.load().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="0 seconds").start(str(tmp_path / "out"))
        query.processAllAvailable()
        query.stop()
        assert sorted(r.trade_seq for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(1, want + 1))
