"""A Python data source over a paged history of sequenced records.

A transport is any picklable object with ``request(method, params) -> dict``; tests pass
one without a network. Every range is read until its distinct sequences are its
whole width, by halving what comes back with holes: neither order nor a has-more
flag proves anything.
"""

from __future__ import annotations

import http.client
import json
import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Protocol
from urllib.parse import urlencode, urlsplit, urlunsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql import types as T

from tallyline.schema import KEY, RECORD, SEQ

#: Requests that one planned range may take.
REQUEST_BUDGET = 32


class Transport(Protocol):
    def request(self, method: str, params: dict[str, Any]) -> dict[str, Any]: ...


class ApiError(Exception):
    """An error that the source reports in a good response; not retried."""

    def __init__(self, code: int | None, message: str, data: Any = None):
        super().__init__(f"source error {code}: {message}")
        self.code, self.message, self.data = code, message, data


class StatusError(Exception):
    """A response of a bad HTTP status."""

    def __init__(self, status: int, retry_after: str | None = None):
        super().__init__(f"HTTP status {status}")
        self.status, self.retry_after = status, retry_after


class IncompleteRange(Exception):
    """A range whose sequences the source does not give in full."""

    def __init__(self, instrument: str, start: int, end: int, covered: int, note: str = ""):
        super().__init__(f"{instrument} [{start}, {end}]: covered {covered}/{end - start + 1}{note}")
        self.instrument, self.start, self.end, self.covered = instrument, start, end, covered


def may_retry(error: Exception) -> bool:
    """Transport failures, HTTP 408, 429 and 5xx."""
    if isinstance(error, StatusError):
        return error.status in (408, 429) or error.status >= 500
    return isinstance(error, (OSError, TimeoutError))


def wait_seconds(error: Exception, attempt: int, draw: Callable[[float, float], float] = random.uniform) -> float:
    """A numeric Retry-After and half a second more, else a random share of a doubling wait, between 1 and 60 seconds."""
    after = getattr(error, "retry_after", None)
    try:
        return float(after) + 0.5
    except (TypeError, ValueError):
        return max(1.0, draw(0.0, min(60.0, 2.0**attempt)))


@dataclass
class TokenBucket:
    """At most ``rate`` requests a second, whatever threads and ranges of this process ask; readers divide a global rate by their number."""

    rate: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _next: float = field(default=0.0, init=False)
    _lock: threading.Lock = field(default_factory=threading.Lock, init=False, repr=False)

    def take(self) -> None:
        with self._lock:
            now = self.clock()
            wait = self._next - now
            self._next = max(now, self._next) + 1.0 / self.rate
        if wait > 0:
            self.sleep(wait)


@dataclass
class HttpTransport:
    """JSON over HTTP GET with the standard library: one connection a thread, kept open between requests."""

    url: str
    proxy: str | None = None
    timeout: float = 60.0
    connect_timeout: float = 10.0
    _held: threading.local = field(default_factory=threading.local, init=False, repr=False, compare=False)

    def __reduce__(self):
        return type(self), (self.url, self.proxy, self.timeout, self.connect_timeout)

    def _connection(self) -> http.client.HTTPConnection:
        """This thread's connection, made with the connect timeout; reads have the other."""
        if (held := getattr(self._held, "connection", None)) is not None:
            return held
        target, proxy = urlsplit(self.url), urlsplit(self.proxy) if self.proxy else None
        kind = http.client.HTTPSConnection if target.scheme == "https" else http.client.HTTPConnection
        to = proxy or target
        connection = kind(to.hostname or "", to.port, timeout=self.connect_timeout)
        if proxy and target.scheme == "https":
            connection.set_tunnel(target.hostname or "", target.port or 443)
        connection.connect()
        connection.sock.settimeout(self.timeout)
        self._held.connection = connection
        return connection

    def close(self) -> None:
        if (held := getattr(self._held, "connection", None)) is not None:
            held.close()
            self._held.connection = None

    def request(self, method: str, params: dict[str, Any]) -> dict[str, Any]:
        query = urlencode({k: str(v).lower() if isinstance(v, bool) else v for k, v in params.items()})
        whole = f"{self.url}/{method}?{query}"
        path = whole if self.proxy and whole.startswith("http:") else urlunsplit(("", "", *urlsplit(whole)[2:4], ""))
        try:
            connection = self._connection()
            connection.request("GET", path, headers={"Accept": "application/json", "Host": urlsplit(whole).netloc})
            response = connection.getresponse()
            body = response.read()
        except (OSError, http.client.HTTPException) as error:
            self.close()  # a connection that failed is not used again
            raise error if isinstance(error, OSError) else OSError(str(error) or type(error).__name__) from error
        if response.status >= 400:
            raise StatusError(response.status, response.headers.get("Retry-After"))
        return json.loads(body)


class History:
    """The three questions a plan and a read ask of the source."""

    def __init__(self, transport: Transport, *, attempts: int = 10, page: int = 10_000, bucket: TokenBucket | None = None, sleep: Callable[[float], None] = time.sleep):
        self.transport, self.attempts, self.page, self.bucket, self.sleep = transport, attempts, page, bucket, sleep

    def _ask(self, method: str, params: dict[str, Any]) -> Any:
        for attempt in range(1, self.attempts + 1):
            if self.bucket:
                self.bucket.take()
            try:
                body = self.transport.request(method, params)
            except Exception as error:
                if attempt == self.attempts or not may_retry(error):
                    raise
                self.sleep(wait_seconds(error, attempt))
                continue
            if failed := body.get("error"):
                raise ApiError(failed.get("code"), failed.get("message", ""), failed.get("data"))
            return body["result"]

    def instruments(self, currency: str, kind: str) -> list[dict[str, Any]]:
        """Expired and active instruments, in this order; one that moved between is there twice."""
        return [row for expired in (True, False) for row in self._ask("get_instruments", {"currency": currency, "kind": kind, "expired": expired})]

    def last_seq(self, instrument: str) -> int | None:
        """The last sequence; 0 where the source confirms that there is none; None where it cannot be told."""
        try:
            rows = self._ask("get_last_trades_by_instrument", {"instrument_name": instrument, "count": 1})["trades"]
            return int(rows[0][SEQ]) if rows else 0
        except Exception:
            return None

    def last_seqs(self, instruments: list[str], workers: int = 1) -> list[tuple[str, int | None]]:
        """The bounds of all ``instruments``, asked for by so many threads; the bucket holds them to one rate."""
        with ThreadPoolExecutor(max(1, workers)) as pool:
            return list(zip(instruments, pool.map(self.last_seq, instruments), strict=True))

    def chunk(self, instrument: str, start: int, end: int) -> tuple[list[dict[str, Any]], bool]:
        got = self._ask("get_last_trades_by_instrument", {"instrument_name": instrument, "start_seq": start, "end_seq": end, "count": self.page})
        return got["trades"], bool(got["has_more"])

    def whole(self, instrument: str, start: int, end: int, budget: int = REQUEST_BUDGET) -> list[dict[str, Any]]:
        """The rows of a closed range, proved whole; parts with holes are halved and asked for again, ``budget`` requests in all."""
        parts, out, used = [(start, end)], [], 0
        while parts:
            a, b = parts.pop()
            if used == budget:
                raise IncompleteRange(instrument, start, end, len({int(r[SEQ]) for r in out}), f" after {used} requests")
            used += 1
            rows = [r for r in self.chunk(instrument, a, b)[0] if a <= int(r[SEQ]) <= b]
            covered = len({int(r[SEQ]) for r in rows})
            if covered == b - a + 1:
                out += rows
            elif not rows or a == b:
                raise IncompleteRange(instrument, a, b, covered)
            else:
                middle = (a + b) // 2
                parts += [(middle + 1, b), (a, middle)]
        return out


@dataclass
class Ranges(InputPartition):
    """What one reader fetches, one range after another."""

    ranges: list[tuple[str, int, int]]


#: With each record its range; of a range that was not proved, one row with the reason in place of records.
RANGED = T.StructType([*RECORD.fields, T.StructField("range_instrument", T.StringType()), T.StructField("range_start", T.LongType()), T.StructField("range_end", T.LongType()), T.StructField("error", T.StringType())])


def _row(record: dict[str, Any], instrument: str, schema: T.StructType) -> tuple:
    kinds = {"long": int, "double": float, "string": str}
    given = {KEY: instrument} | record
    return tuple(None if (v := given.get(f.name)) is None else kinds[f.dataType.simpleString().replace("bigint", "long")](v) for f in schema)


class HistorySource(DataSource):
    """``format("history")``: options ``ranges`` (JSON list of [instrument, start, end]), ``transport``
    (name of a registered factory), ``chunk_size``, ``max_rps``, ``readers`` and ``on_error`` (fail or report).

    There are at most ``readers`` partitions, each with its share of ``max_rps``, and one bucket in
    each process, so the rate holds over all ranges. With ``report`` the columns are those of ``RANGED``:
    a range that has holes, or fails in transport after all attempts, is one row with the reason. Any other
    error (of the source, a schema or a program) fails the query.
    """

    @classmethod
    def name(cls) -> str:
        return "history"

    def schema(self) -> T.StructType:
        return RANGED if self.options.get("on_error") == "report" else RECORD

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return HistoryReader(dict(self.options), schema)

    def simpleStreamReader(self, schema: T.StructType) -> SimpleDataSourceStreamReader:
        return HistoryStream(dict(self.options), schema)


#: Factories of transports by name; a factory takes the options and is looked up in the process that reads.
TRANSPORTS: dict[str, Callable[[dict[str, str]], Transport]] = {"http": lambda o: HttpTransport(o["url"], o.get("proxy"))}


def _transport(options: dict[str, str]) -> Transport:
    """The transport that ``options`` name: a registered one, or ``module:factory``."""
    name = options.get("transport", "http")
    if name in TRANSPORTS:
        return TRANSPORTS[name](options)
    from importlib import import_module

    module, _, factory = name.partition(":")
    return getattr(import_module(module), factory)(options)


_BUCKETS: dict[tuple, TokenBucket] = {}


def bucket_of(options: dict[str, str]) -> TokenBucket:
    """The one bucket of this process for a source and rate."""
    key = tuple(options.get(k) for k in ("transport", "url", "max_rps", "readers"))
    return _BUCKETS.setdefault(key, TokenBucket(float(options.get("max_rps", 20)) / max(1, int(options.get("readers", 1)))))


def _history(options: dict[str, str]) -> History:
    attempts = int(options.get("attempts", 10))
    return History(_transport(options), attempts=attempts, page=int(options.get("chunk_size", 10_000)), bucket=bucket_of(options))


def driver_history(options: dict[str, str]) -> History:
    """The history that ``options`` name, for the questions of a plan."""
    return _history(options)


class HistoryReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.schema = options, schema

    def partitions(self) -> list[Ranges]:
        ranges = [(str(i), int(a), int(b)) for i, a, b in json.loads(self.options["ranges"])]
        n = max(1, min(len(ranges), int(self.options.get("readers", 1))))
        return [Ranges(ranges[k::n]) for k in range(n)]

    def read(self, partition: Ranges) -> Iterator[tuple]:
        history, reports = _history(self.options), self.options.get("on_error") == "report"
        for instrument, start, end in partition.ranges:
            try:
                rows = history.whole(instrument, start, end)
            except Exception as error:
                if not reports or not (isinstance(error, IncompleteRange) or may_retry(error)):
                    raise
                yield (*[None] * len(RECORD), instrument, start, end, f"{type(error).__name__}: {error}")
                continue
            own = (instrument, start, end, None) if reports else ()
            for record in rows:
                yield (*_row(record, instrument, RECORD if reports else self.schema), *own)


class HistoryStream(SimpleDataSourceStreamReader):
    """One instrument from ``start`` on, a proved page at a time; the offset is the next sequence."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.schema = options, schema

    def initialOffset(self) -> dict:
        return {"next": int(self.options.get("start", 1))}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        history, instrument = _history(self.options), self.options["instrument"]
        last = history.last_seq(instrument)
        end = min(start["next"] + history.page - 1, last or 0)
        if end < start["next"]:
            return iter(()), start
        return iter([_row(r, instrument, self.schema) for r in history.whole(instrument, start["next"], end)]), {"next": end + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        history, instrument = _history(self.options), self.options["instrument"]
        return iter([_row(r, instrument, self.schema) for r in history.whole(instrument, start["next"], end["next"] - 1)])

    def commit(self, end: dict) -> None:
        """Nothing to release: the source keeps its history."""
