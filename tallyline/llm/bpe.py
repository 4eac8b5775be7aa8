"""Byte-level BPE encoding and decoding by replaying merges over a corpus of words.

The distinct unseen words of a batch of texts are laid out as one list of symbols. An
inverted index holds the positions of every pair of neighbouring tokens that may merge,
under the rank of the token it makes: pairs that make the same token are one entry, as
of those the leftmost goes first. Ranks are taken in order from a heap; a merge is
applied to all its positions, and touches these and their two neighbours only. Each word is worked out once and kept
in a bounded table of the worker, so a text costs one lookup a word.

The batch is the unit, not the whole input: words merge independently of each other, so the ids are the
same, and a table of all words would be shuffled and joined to the texts twice, more bytes than the texts have.

Defined results: a null or empty text has no tokens and decodes to no bytes; other
columns of the input are left out of ``encode``'s result unless named in ``keep``;
rows that repeat are encoded alike, each by itself; an empty table gives none. Of pairs of one rank that
overlap the leftmost merges. A text of any length is encoded
whole, its words a slice at a time.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import blank, kept, text_batches

#: Words that either table of a worker holds, and the longest word it takes.
TABLE_WORDS, TABLE_CHARS = 150_000, 64
#: Pairs of tokens whose rank a worker keeps.
PAIRS = 200_000
#: From so many words on, a merge is applied to all its positions at once.
VECTOR_WORDS = 500
#: Words that are looked at together.
SLICE_WORDS = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def _indexed(index: dict[int, list], ranks: np.ndarray, positions: np.ndarray) -> list[int]:
    """Add positions to the index under their ranks; the ranks that were not in it."""
    order = np.argsort(ranks, kind="stable")
    order = order[np.searchsorted(ranks[order], 0) :]
    ranks, positions = ranks[order], positions[order]
    if not len(ranks):
        return []
    cuts = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]])).tolist()
    fresh = []
    for a, b, r in zip(cuts, [*cuts[1:], len(ranks)], ranks[cuts].tolist(), strict=True):
        if r in index:
            index[r].append(positions[a:b])
        else:
            index[r] = [positions[a:b]]
            fresh.append(r)
    return fresh


class MergeReplay:
    """Encodes lists of words together, by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.width = len(self.tokens)
        self.pairs: dict[int, int] = {}
        made = [(ranks[t[:k]] * self.width + ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        keys, values = (np.array(x, np.int64) for x in (zip(*made, strict=True) if made else ((), ())))
        order = np.argsort(keys)
        self.keys, self.values = np.append(keys[order], np.iinfo(np.int64).max), np.append(values[order], -1)
        self.near = self._ranks(self.first[:, None], self.first[None])

    def _rank(self, left: int, right: int) -> int:
        """The rank at which two tokens merge, or -1."""
        key = left * self.width + right
        rank = self.pairs.get(key)
        if rank is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            rank = self.pairs[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return rank

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks at which pairs of tokens merge, -1 where they don't."""
        keys = left * self.width + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.values[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        whole = self.ranks
        known = [whole.get(w, -1) for w in words]
        split = [w for w, k in zip(words, known, strict=True) if k < 0]
        made = iter(self._encode(split, len(split) >= VECTOR_WORDS))
        return [next(made) if k < 0 else k.to_bytes(4, "little") for k in known]

    def _encode(self, words: list[bytes], vector: bool) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer(b"".join(words), np.uint8)
        tok = self.first[codes]
        if not len(tok):
            return [b""] * len(words)
        ends = np.cumsum(sizes)
        nxt, prv = np.arange(1, len(tok) + 1), np.arange(-1, len(tok) - 1)
        nxt[ends[sizes > 0] - 1] = -1
        prv[(ends - sizes)[sizes > 0]] = -1
        index: dict[int, list] = {}
        due = np.full(len(tok), -1)  # the rank at which a position merges with the next
        at = np.flatnonzero(nxt >= 0)
        due[at] = self.near[codes[at], codes[at + 1]]
        _indexed(index, due, np.arange(len(tok)))
        heap = list(index)
        heapq.heapify(heap)
        odd: np.ndarray | list = []
        if vector:
            odd = self._vector(tok, nxt, prv, due, index, heap)
        else:
            tok = self._one_by_one(tok, nxt, prv, {r: np.concatenate(x).tolist() for r, x in index.items()}, heap)
        alive = tok >= 0
        cuts = 4 * np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])]
        blob, cuts = tok[alive].astype("<u4").tobytes(), cuts.tolist()
        out = [blob[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        again = np.unique(np.searchsorted(ends, odd, "right")).tolist()
        for k, ids in zip(again, self._encode([words[k] for k in again], False) if again else (), strict=True):
            out[k] = ids
        return out

    def _vector(self, tok: np.ndarray, nxt: np.ndarray, prv: np.ndarray, due: np.ndarray, index: dict, heap: list[int]) -> np.ndarray:
        """Replay the merges, all positions of a rank at once.

        Returns positions in words where a pair of a lower rank arose, which must go first: those words are to be done again.
        """
        odd = []
        while heap:
            rank = heapq.heappop(heap)
            p = np.concatenate(index.pop(rank))
            p = p[due[p] == rank]  # an earlier merge took one of the others
            if not len(p):
                continue
            p.sort()
            p = p[np.append(True, p[1:] != p[:-1])]
            q = nxt[p]
            run = np.flatnonzero(np.concatenate([[True], p[1:] != q[:-1]]))
            if len(run) < len(p):  # of pairs that overlap, each second one from the left
                p = p[(np.arange(len(p)) - np.repeat(run, np.diff(np.append(run, len(p))))) % 2 == 0]
                q = nxt[p]
            n = nxt[q]
            tok[p], tok[q], nxt[p], due[p], due[q] = rank, -1, n, -1, -1
            after = n >= 0
            prv[n[after]] = p[after]
            m = prv[p]
            left = np.concatenate([p[after], m[m >= 0]])
            due[left] = ranks = self._ranks(tok[left], tok[nxt[left]])
            odd.append(left[(ranks >= 0) & (ranks < rank)])
            for r in _indexed(index, ranks, left):
                heapq.heappush(heap, r)
        return np.concatenate(odd) if odd else np.zeros(0, np.int64)

    def _one_by_one(self, tok: np.ndarray, nxt: np.ndarray, prv: np.ndarray, index: dict[int, list[int]], heap: list[int]) -> np.ndarray:
        """Replay the merges position by position."""
        rank_of = self._rank
        tok, nxt, prv = tok.tolist(), nxt.tolist(), prv.tolist()
        while heap:
            rank = heapq.heappop(heap)
            positions = index.pop(rank)
            positions.sort()
            for k, p in enumerate(positions):
                q = nxt[p]
                if q < 0 or tok[p] < 0 or rank_of(tok[p], tok[q]) != rank:
                    continue  # an earlier merge took one of the two
                tok[p], tok[q] = rank, -1
                nxt[p] = n = nxt[q]
                lower = False
                if n >= 0:
                    prv[n] = p
                    if (r := rank_of(rank, tok[n])) >= 0:
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            heapq.heappush(heap, r)
                        lower = r < rank
                if (m := prv[p]) >= 0 and (r := rank_of(tok[m], rank)) >= 0:
                    if r in index:
                        index[r].append(m)
                    else:
                        index[r] = [m]
                        heapq.heappush(heap, r)
                    lower |= r < rank
                if lower:  # a pair of a lower rank arose: it goes first
                    if rest := positions[k + 1 :]:
                        if rank in index:
                            index[rank] += rest
                        else:
                            index[rank] = rest
                            heapq.heappush(heap, rank)
                    break
        return np.array(tok, np.int64)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Encoder:
    """Encodes texts; keeps the ids of words it has met in two bounded tables, the full one becoming the older."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.find = regex.compile(pattern)
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """A table with all words of ``new`` in it; what neither table has is worked out together."""
        new.difference_update(self.table)
        if not new:
            return self.table
        got = {w: self.older[w] for w in new if w in self.older}
        rest = [w for w in new if w not in got]
        got.update(zip(rest, self.replay.encode([w.encode() for w in rest]), strict=True))
        short = {w: x for w, x in got.items() if len(w) <= TABLE_CHARS}
        if len(self.table) + len(short) > TABLE_WORDS:
            self.older, self.table = self.table, short if len(short) <= TABLE_WORDS else {}
            return _Both(got, self.older)
        self.table.update(short)
        return self.table if len(short) == len(got) else _Both(got, self.table)

    def encode(self, texts: list[str]) -> list[bytes]:
        out, parts = [], []
        if sum(map(len, texts)) <= 8 << 20:
            split = [self.find.findall(text) for text in texts]
            table = self._learn(set().union(*split))
            return [b"".join(map(table.__getitem__, words)) for words in split]
        for text in texts:
            found, parts = (m.group() for m in self.find.finditer(text)), []
            while words := list(islice(found, SLICE_WORDS)):
                table = self._learn(set(words))
                parts.append(b"".join(map(table.__getitem__, words)))
            out.append(b"".join(parts))
        return out


class _Both(dict):
    """A dictionary that falls back on another."""

    def __init__(self, own: dict, other: dict):
        super().__init__(own)
        self.other = other

    def __missing__(self, key):
        return self.other[key]


def _encoder(path: str, pattern: str) -> Encoder:
    """One for each worker process, kept between its tasks."""
    return kept("bpe", (path, pattern), lambda: Encoder(load_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """``keep``, ``ids`` (little-endian unsigned 32-bit, as binary), ``n_tokens``; with ``decoded`` the bytes the ids stand for.

    ``path`` is a rank file that every executor can read, ``pattern`` splits texts into words.
    """
    chosen = docs.select(*keep, blank(text).alias("__text"))
    fields = [f.simpleString().replace(":", " ", 1) for f in chosen.schema.fields[:-1]]
    schema = ", ".join([*(f"`{f.split(' ', 1)[0]}` {f.split(' ', 1)[1]}" for f in fields), "ids binary", "n_tokens long", *(["decoded binary"] * decoded)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in text_batches(batches, "__text"):
            ids = encoder.encode(batch.column("__text").to_pylist())
            columns = [*(batch.column(k) for k in keep), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if decoded:
                columns.append(pa.array([encoder.replay.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "n_tokens", *(["decoded"] * decoded)])

    return chosen.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, *, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``decoded``, the bytes of each row's ids; null ids decode to no bytes."""
    chosen = encoded.select(*keep, ids)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]), "decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = _encoder(path, "").replay
        for batch in batches:
            out = [replay.decode(x or b"") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(out, pa.binary())], names=[*keep, "decoded"])

    return chosen.mapInArrow(run, schema)
