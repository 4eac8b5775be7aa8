"""Benchmark decontamination: pigeonhole pieces, exact hits, bit-parallel verification.

An item of m characters is found in a text where some substring is within k = m // 16
edits of it. Cut into k + 1 pieces, one piece must then stand unchanged, at most k
places from where the item's start puts it. All pieces of all items go into one
automaton; each text is scanned once, and the neighbourhoods of hits are verified with
Myers' bit-parallel distance, in one integer of m bits. Nothing is sampled or cut: the
result is that of comparing each item with each text at every place.

Both sides are lower-cased and their white space runs are one space; positions are in
that form of the text. Documents are scanned where they lie, without a shuffle, so
copies and long texts cost their own length only. Items go to the tasks in blocks of
``BLOCK_CHARS`` characters at most, one scan for each block.

Defined results: null, empty or blank texts match nothing, nor do such items; items that
repeat are items of their own; rows of documents that repeat give rows that repeat;
an empty table on either side gives no row. Texts are taken whole, a few MB of them at a time and
one at least. Columns of the documents may have any name: ``clean`` returns all as they are, and a kept column
named like one of the results is returned as ``doc_`` and its name.

All items are read to the driver once, as a stated query set; a block of items is one more scan of the
documents, so the work is that of blocks times texts (16 MB of items are over 100,000 of 150 characters).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank, fresh_name, kept, text_batches

#: Characters of an item for each edit of its budget.
PER_EDIT = 16
#: Characters of items in one automaton.
BLOCK_CHARS = 16 << 20


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces of nearly equal length with their offsets."""
    n, m = edits + 1, len(item)
    cuts = [m * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def distances(item: str, text: str, anchored: bool = False) -> Iterator[int]:
    """For each place of ``text``, the fewest edits between ``item`` and a substring that ends there.

    With ``anchored`` the substring is the whole of ``text`` up to there.
    """
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    for c in text:
        eq = at.get(c, 0)
        v = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(h | up))
        minus = up & h
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus = (plus << 1 | anchored) & full
        up = (minus << 1 | (full & ~(v | plus))) & full
        down = plus & v
        yield score


def best_match(item: str, text: str, spans: list[tuple[int, int]], edits: int) -> tuple[int, int, int] | None:
    """Fewest edits (``edits`` at most), start and stop of the first best match inside ``spans`` of ``text``."""
    best: tuple[int, int] | None = None
    for a, b in spans:
        for k, d in enumerate(distances(item, text[a:b])):
            if d <= edits and (best is None or d < best[0]):
                best = (d, a + k + 1)
                if not d:
                    break
        if best and not best[0]:
            break
    if best is None:
        return None
    d, stop = best
    back = text[max(0, stop - len(item) - d) : stop][::-1]
    for k, got in enumerate(distances(item[::-1], back, anchored=True)):
        if got == d:
            return d, stop - k - 1, stop
    return d, stop, stop


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = items
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item) in enumerate(items):
            for offset, piece in pieces(item, len(item) // PER_EDIT):
                owners.setdefault(piece, []).append((k, offset))
        for piece, owned in owners.items():
            self.automaton.add_word(piece, (len(piece), owned))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(index of the item, edits, start, stop) of the best match of each item that is in ``text``."""
        starts: dict[int, set[int]] = {}
        for last, (size, owned) in self.automaton.iter(text):
            for k, offset in owned:
                starts.setdefault(k, set()).add(last + 1 - size - offset)
        out = []
        for k, found in starts.items():
            item = self.items[k][1]
            m = len(item)
            edits = m // PER_EDIT
            exact = min((s for s in found if s >= 0 and text.startswith(item, s)), default=None)
            if exact is not None:
                out.append((k, 0, exact, exact + m))
                continue
            spans: list[tuple[int, int]] = []
            for s in sorted(found):
                a, b = max(0, s - edits), min(len(text), s + m + edits)
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
                else:
                    spans.append((a, b))
            if (got := best_match(item, text, spans, edits)) is not None:
                out.append((k, *got))
        return out


def _matcher(items: list[tuple[int, str]]) -> Matcher:
    return kept("decontaminate", (hash(tuple(items)),), lambda: Matcher(items))


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> list[list[tuple[int, str]]]:
    """The items with text, in blocks; the stated query set, which every document is compared with."""
    blocks: list[list[tuple[int, str]]] = []
    held = BLOCK_CHARS + 1
    for row in benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).cast("string").alias("t")).toLocalIterator():
        if item := plain(row.t):
            if held + len(item) > BLOCK_CHARS:
                blocks.append([])
                held = 0
            blocks[-1].append((row.i, item))
            held += len(item)
    return blocks


SCHEMA = "item_id long, edits int, start long, stop long"


def matches(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``keep``, item_id, edits, start and stop: the best match of each item in each document that has it."""
    taken = {f.split(" ")[0] for f in SCHEMA.split(", ")}
    names = [f"doc_{k}" if k in taken else k for k in keep]
    held = fresh_name(names)
    chosen = docs.select(*(F.col(k).alias(n) for k, n in zip(keep, names, strict=True)), blank(text).alias(held))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    schema = ", ".join([*fields, SCHEMA])

    def scan(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(items)
            for batch in text_batches(batches, held):
                rows, found = [], []
                for row, value in enumerate(batch.column(held).to_pylist()):
                    for k, edits, start, stop in matcher.find(plain(value)):
                        rows.append(row)
                        found.append((matcher.items[k][0], edits, start, stop))
                if rows:
                    ids, edits, starts, stops = zip(*found, strict=True)
                    take = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*(take.column(c) for c in names), pa.array(ids, pa.int64()), pa.array(edits, pa.int32()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], names=[*names, "item_id", "edits", "start", "stop"])

        return run

    out = None
    for items in _blocks(benchmark, item_id, item_text):
        one = chosen.mapInArrow(scan(items), schema)
        out = one if out is None else out.unionByName(one)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their columns; nothing is shuffled."""
    columns = docs.columns
    held = fresh_name(columns)
    chosen = docs.withColumn(held, blank(text))
    blocks = _blocks(benchmark, "item_id", "text")

    def drop(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(items)
            for batch in text_batches(batches, held):
                keep = [not matcher.find(plain(value)) for value in batch.column(held).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return run

    for items in blocks:
        chosen = chosen.mapInArrow(drop(items), chosen.schema)
    return chosen.select(*columns)
