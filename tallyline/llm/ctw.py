"""Language-model scoring by context-tree weighting over bytes, beside a unigram base.

A byte is eight binary decisions, each in the context of up to ``DEPTH`` bytes before
it. Every context and decision has a Krichevsky-Trofimov estimator over the counts of
the learning texts; a node's weighted probability is half its own estimate and half the
product of its children's, and so a decision's probability mixes the estimates
of all depths, with weights that follow from the counts in closed form. A path ends at
the deepest context that learning met. Texts are lower-cased (A-Z) and end in a byte
that UTF-8 never has, which is also the context before their start. The code length of a text is the
negative logarithm of its probability; ``bits_per_byte`` divides it by its bytes and end.

Counts are of runs of ``DEPTH`` + 1 bytes, dealt into buckets by the two context bytes
nearest the decision, so that subtrees below depth two are whole in one bucket; of depths
zero and one, tables of fixed size are summed. Words are dealt by hash. Texts are dealt
into blocks; a block asks each bucket for its distinct runs and words, as packed arrays, and
gets one number for each. The model is never in one place and no task holds more than
a block or a bucket; both are sized by the input, and what is gathered grows with it.

Defined results: a null or empty text is its end alone; rows that repeat learn and score
as often as they are there; a null id counts as the empty id; without learning texts
every decision is one half and every count zero; an empty table gives no row. Other columns
are not read; a text of any length is scored whole, in one block with others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank, deal, materialize, partitions_for, release, summed, text_batches
from .shingles import words

DEPTH = 5
END = 255
BLOCK_MB, LEAST_BLOCKS = 8, 64
#: Blocks that one task answers for a bucket: of a bucket that all ask, each so many blocks get a copy.
ASKERS = 4096
#: Bytes of texts that are looked at together.
STEP = 1 << 20
_LOG_HALF = float(np.log(0.5))
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def runs(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and end of the texts: it in the low byte, then the bytes before it, nearest first; and where texts begin."""
    pad = bytes([END]) * DEPTH
    buffer = _LOW[np.frombuffer(b"".join([x for raw in raws for x in (pad, raw)] + [pad]), np.uint8)]
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    out = buffer[DEPTH:].astype(np.uint64)
    for k in range(1, DEPTH + 1):
        out |= buffer[DEPTH - k : len(buffer) - k].astype(np.uint64) << np.uint64(8 * k)
    # A text's bytes are followed by the first byte of the next padding, its end; the rest of that is no text.
    begins = np.concatenate([[0], np.cumsum(sizes + DEPTH)])[:-1]
    keep = np.zeros(len(out), np.int8)
    np.add.at(keep, begins, 1)
    np.add.at(keep, np.minimum(begins + sizes + 1, len(out) - 1), -1)
    mask = np.cumsum(keep, dtype=np.int8) > 0
    if len(raws):
        mask[-1] = mask[-1] and begins[-1] + sizes[-1] == len(out) - 1
        mask[begins[-1] + sizes[-1]] = True
    return out[mask], np.concatenate([[0], np.cumsum(sizes + 1)])


def reduced(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts (of ones, if none)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.concatenate([first, [len(keys)]]))
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def run_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    near = keys >> np.uint64(8) & np.uint64(0xFFFF)
    return (near * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(buckets)


def word_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return keys % np.uint64(buckets)


_BUCKET = {"run": run_bucket, "word": word_bucket}


def packed(kind: str, keys: np.ndarray, counts: np.ndarray | None, buckets: int) -> list[tuple]:
    """(bucket, kind, keys, counts) for the buckets that have any; keys stay ascending."""
    to = _BUCKET[kind](keys, buckets)
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64)).tolist()
    keys = keys[order]
    counts = None if counts is None else counts[order].astype(np.int64)
    return [(k, kind, keys[a:b].tobytes(), None if counts is None else counts[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]


def _steps(texts: list[str]) -> Iterator[list[bytes]]:
    out, held = [], 0
    for text in texts:
        out.append(text.encode())
        held += len(out[-1])
        if held > STEP:
            yield out
            out, held = [], 0
    if out:
        yield out


class _Gatherer:
    """Distinct keys with counts, merged whenever the loose ones outgrow the merged."""

    def __init__(self):
        self.loose: list[tuple] = []
        self.held, self.merged = 0, 0

    def add(self, keys: np.ndarray) -> None:
        self.loose.append(reduced(keys))
        self.held += len(self.loose[-1][0])
        if self.held > 2 * self.merged + 1_000_000:
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.loose) != 1:
            keys = np.concatenate([k for k, _ in self.loose] or [np.zeros(0, np.uint64)])
            self.loose = [reduced(keys, np.concatenate([c for _, c in self.loose] or [np.zeros(0, np.int64)]))]
        self.held = self.merged = len(self.loose[0][0])
        return self.loose[0]


# ----------------------------------------------------------------- the tree


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(7):
        low = y < 8
        shift -= np.log(np.where(low, y, 1.0))
        y = np.where(low, y + 1, y)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The Krichevsky-Trofimov probability of so many zeros and ones, as a natural logarithm."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _context(keys: np.ndarray, depth: int) -> np.ndarray:
    return keys >> np.uint64(8) & np.uint64((1 << 8 * depth) - 1)


def _decisions(keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bit of each key's byte: the node (context of ``depth``, bits before) and the bit."""
    byte = keys & np.uint64(255)
    base = _context(keys, depth) << np.uint64(8)
    nodes = np.concatenate([base | (np.uint64(1 << k) | byte >> np.uint64(8 - k)) for k in range(8)])
    bits = np.concatenate([byte >> np.uint64(7 - k) & np.uint64(1) for k in range(8)])
    return nodes, bits.astype(bool)


class Subtrees:
    """The nodes from depth two on of the runs of a bucket."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels: dict[int, tuple] = {}
        below = None
        for depth in range(DEPTH, 1, -1):
            nodes, bits = _decisions(keys, depth)
            each = np.tile(counts.astype(float), 8)
            own, at = np.unique(nodes, return_inverse=True)
            ones = np.bincount(at, each * bits, len(own))
            zeros = np.bincount(at, each * ~bits, len(own))
            kt = log_kt(zeros, ones)
            if below is None:
                weighted, share = kt, np.ones(len(own))
            else:
                inner, value = below
                parent = _context(inner, depth) << np.uint64(8) | inner & np.uint64(255)
                weighted = np.logaddexp(kt, np.bincount(np.searchsorted(own, parent), value, len(own))) + _LOG_HALF
                share = np.exp(kt + _LOG_HALF - weighted)
            self.levels[depth] = (own, zeros, ones, share)
            below = own, weighted
        self.nodes, self.weighted = below

    def top(self) -> np.ndarray:
        """What depth one needs of this bucket, by nearest byte and bits before: weighted sums, zeros, ones."""
        out = np.zeros((3, 256 * 256))
        own, zeros, ones, _ = self.levels[2]
        parent = (_context(own, 1) << np.uint64(8) | own & np.uint64(255)).astype(np.int64)
        for row, value in enumerate((self.weighted, zeros, ones)):
            out[row] = np.bincount(parent, value, 256 * 256)
        return out

    def log10(self, keys: np.ndarray, top: dict) -> np.ndarray:
        """The probability of each run's byte in its context, as a decimal logarithm."""
        chance = np.full(8 * len(keys), np.nan)
        for depth in range(DEPTH, 1, -1):
            own, zeros, ones, share = self.levels[depth]
            nodes, bits = _decisions(keys, depth)
            if len(own):
                at = np.minimum(np.searchsorted(own, nodes), len(own) - 1)
                chance = _mixed(chance, own[at] == nodes, bits, zeros[at], ones[at], share[at])
        for depth in (1, 0):
            nodes, bits = _decisions(keys, depth)
            zeros, ones, share = (x[nodes.astype(np.int64)] for x in top[depth])
            chance = _mixed(chance, zeros + ones > 0, bits, zeros, ones, share)
        chance = np.where(np.isnan(chance), 0.5, chance)
        return np.log10(chance).reshape(8, -1).sum(0)


def _mixed(below, met, bits, zeros, ones, share):
    own = (np.where(bits, ones, zeros) + 0.5) / (zeros + ones + 1)
    return np.where(met, np.where(np.isnan(below), own, share * own + (1 - share) * below), below)


def top_tables(sums: np.ndarray) -> dict:
    """Zeros, ones and own share of the nodes of depths one and zero, from the sums over buckets."""
    inner, zeros, ones = sums
    kt = log_kt(zeros, ones)
    weighted = np.where(zeros + ones > 0, np.logaddexp(kt, inner) + _LOG_HALF, 0.0)
    tables = {1: (zeros, ones, np.exp(np.minimum(kt + _LOG_HALF - weighted, 0.0)))}
    zeros, ones, inner = (x.reshape(256, 256).sum(0) for x in (zeros, ones, weighted))
    kt = log_kt(zeros, ones)
    tables[0] = zeros, ones, np.exp(np.minimum(kt - np.logaddexp(kt, inner), 0.0))
    return tables


# ----------------------------------------------------------------- Spark

_PACKED = "bucket int, kind string, keys binary, counts binary"
_KINDS = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def learned(docs: DataFrame, buckets: int) -> DataFrame:
    """Counts of runs and words of the learning texts: from each task, one packed array for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = _Gatherer(), _Gatherer()
        for batch in text_batches(batches, "text", STEP):
            for raws in _steps(batch.column("text").to_pylist()):
                held.add(runs(raws)[0])
                tokens.add(words(raws)[0])
        rows = packed("run", *held.result(), buckets) + packed("word", *tokens.result(), buckets)
        for k in range(0, len(rows), 64):
            yield _table(rows[k : k + 64], _KINDS)

    return docs.where("not held_out").select("text").mapInArrow(run, _PACKED)


def _merge(table: pa.Table) -> pa.Table:
    rows = []
    bucket = table.column("bucket")[0].as_py()
    for kind in ("run", "word"):
        own = table.filter(pa.compute.equal(table.column("kind"), kind))
        if len(own):
            keys = np.concatenate([np.frombuffer(x, np.uint64) for x in own.column("keys").to_pylist()])
            counts = np.concatenate([np.frombuffer(x, np.int64) for x in own.column("counts").to_pylist()])
            keys, counts = reduced(keys, counts)
            rows.append((bucket, kind, keys.tobytes(), counts.tobytes()))
    return pa.Table.from_batches([_table(rows, _KINDS)])


def _model(table: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray]:
    for row in table.to_pylist():
        if row["kind"] == kind and row["counts"] is not None:
            return np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)
    return np.zeros(0, np.uint64), np.zeros(0, np.int64)


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["counts"], np.int64)
            out = np.zeros(3 * 65536 + 2)
            if row["kind"] == "run":
                out[:-2] = Subtrees(np.frombuffer(row["keys"], np.uint64), counts).top().ravel()
            else:
                out[-2:] = counts.sum(), len(counts)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["v"])


_ASKED = pa.schema([("block", pa.int32()), *_KINDS])


def _ask(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        release("ctw")
        held, tokens = _Gatherer(), _Gatherer()
        for raws in _steps(table.column("text").to_pylist()):
            held.add(runs(raws)[0])
            tokens.add(words(raws)[0])
        block = table.column("block")[0].as_py()
        rows = packed("run", held.result()[0], None, buckets) + packed("word", tokens.result()[0], None, buckets)
        return pa.Table.from_batches([_table([(block, *r) for r in rows], _ASKED)])

    return run


def _answer(top: dict):
    def run(asked: pa.Table, model: pa.Table) -> pa.Table:
        rows = []
        for kind in ("run", "word"):
            own = asked.filter(pa.compute.equal(asked.column("kind"), kind))
            if not len(own):
                continue
            wants = [np.frombuffer(x, np.uint64) for x in own.column("keys").to_pylist()]
            every = np.unique(np.concatenate(wants))
            keys, counts = _model(model, kind)
            if kind == "run":
                tree = Subtrees(keys, counts)
                values = np.concatenate([tree.log10(every[k : k + 50_000], top) for k in range(0, len(every), 50_000)])
            else:
                values = np.zeros(len(every))
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, every), len(keys) - 1)
                    values = np.where(keys[at] == every, counts[at], 0).astype(float)
            for block, want in zip(own.column("block").to_pylist(), wants, strict=True):
                got = values[np.searchsorted(every, want)]
                rows.append((block, own.column("bucket")[0].as_py(), kind, None, got.astype(np.float32 if kind == "run" else np.float64).tobytes()))
        return pa.Table.from_batches([_table(rows, _ASKED)])

    return run


def _answers(table: pa.Table, kind: str, number) -> np.ndarray:
    own = table.filter(pa.compute.equal(table.column("kind"), kind))
    order = np.argsort(own.column("bucket").to_numpy())
    blobs = own.column("counts").to_pylist()
    return np.frombuffer(b"".join(blobs[k] for k in order), number)


def _score(buckets: int, total: int, distinct: int, ends: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        release("ctw")
        values = {"run": _answers(answers, "run", np.float32), "word": _answers(answers, "word", np.float64)}
        held, tokens = _Gatherer(), _Gatherer()
        texts = docs.column("text").to_pylist()
        for raws in _steps(texts):
            held.add(runs(raws)[0])
            tokens.add(words(raws)[0])
        sorted_keys = {}
        for kind, gathered in (("run", held), ("word", tokens)):
            keys = gathered.result()[0]
            order = np.argsort(_BUCKET[kind](keys, buckets), kind="stable")
            value = np.empty(len(keys))
            value[order] = values[kind]
            sorted_keys[kind] = keys, value
        scores, bases, sizes, known, lengths = [], [], [], [], []
        below = np.log10(total + distinct + 1.0)
        end_score = float(np.log10(ends + 1.0) - below)
        for raws in _steps(texts):
            keys, begins = runs(raws)
            table, value = sorted_keys["run"]
            sums = np.concatenate([[0.0], np.cumsum(value[np.searchsorted(table, keys)])])
            scores.append(sums[begins[1:]] - sums[begins[:-1]])
            lengths.append(np.diff(begins))  # of bytes and the end
            keys, begins = words(raws)
            table, value = sorted_keys["word"]
            count = value[np.searchsorted(table, keys)] if len(keys) else np.zeros(0)
            for out, each in ((bases, np.log10(count + 1.0) - below), (known, (count > 0).astype(float))):
                sums = np.concatenate([[0.0], np.cumsum(each)])
                out.append(sums[begins[1:]] - sums[begins[:-1]])
            sizes.append(np.diff(begins))
        n = np.concatenate(sizes) + 1
        return pa.table(
            {
                "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(np.rint(np.concatenate(known)).astype(np.int64) + (ends > 0)), "train_tokens": pa.array(np.full(len(n), total, np.int64)),
                "base_score": pa.array(np.concatenate(bases) + end_score), "score": pa.array(np.concatenate(scores)),
                "bits_per_byte": pa.array(-np.concatenate(scores) / np.log10(2) / np.concatenate(lengths)),
            }
        )

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Scores of every row of ``docs``, learned from those that are not held out."""
    blocks = partitions_for(docs, BLOCK_MB, least=LEAST_BLOCKS)
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), blank(text).alias("text")).withColumn("held_out", held_out())
    merged = learned(chosen, blocks).groupBy("bucket").applyInArrow(_merge, _PACKED)
    model = materialize(merged, "ctw-model")
    sums = summed(model.mapInArrow(_tops, "v binary"), 3 * 65536 + 2)
    top = top_tables(sums[:-2].reshape(3, -1))
    ends = chosen.where("not held_out").select("held_out").count()
    total, distinct = round(sums[-2]) + ends, round(sums[-1]) + (ends > 0)
    dealt = deal(chosen, blocks)
    asked = dealt.groupBy("block").applyInArrow(_ask(blocks), f"block int, {_PACKED}").withColumn("turn", F.pmod("block", F.lit(-(-blocks // ASKERS))))
    turns = model.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // ASKERS))))
    answers = asked.groupBy("bucket", "turn").cogroup(turns.groupBy("bucket", "turn")).applyInArrow(_answer(top), f"block int, {_PACKED}")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(blocks, total, distinct, ends), RESULT)
