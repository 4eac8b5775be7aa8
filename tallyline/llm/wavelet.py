"""Token ids in wavelet-matrix shards: succinct bit-planes with rank and select.

A shard file holds the ids of consecutive documents. Plane ``l`` has bit ``l`` (from
the highest) of every id, in the order that stable partitions by the planes above
leave; a directory of ones before each block of 512 bits makes rank O(1), and with
it access and counting take one step a plane, and occurrence lookup one binary search of the directory, from the one file.
A shard takes ``bits`` of an id, not 32, and about 6 % more for the directories; the planes are succinct, not entropy-coded.

File format, all integers little-endian: magic ``TLWM``, version u32, bits u32, docs
u64, null doc ids u64 (they come first), ids u64, zeros of each plane u64; doc ids i64
and ends u64 of the documents; then for each plane its bytes, padded to 64, and its
directory of u32.

Defined results: null or empty texts are a document of the end id alone; repeated ids
of documents are documents of their own, ordered by their text; an empty table gives
no shard and no row; columns of the input besides the two named are not read.
"""

from __future__ import annotations

import array
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import MOST_PARTITIONS, blank, kept, partitions_for, shared_path, text_batches

MAGIC, VERSION, BLOCK = b"TLWM", 1, 512
HEAD = struct.Struct("<4sIIQQQ")
#: Words that either table of a worker holds, and the longest it takes.
TABLE_WORDS, TABLE_CHARS = 500_000, 64
#: MB of input, as estimated by the optimiser, for each shard.
SHARD_MB = 12
#: Ids from which a task closes a shard and begins the next.
SHARD_IDS = 16 << 20


#: Places that are moved at a time, so that they stay in the processor's cache.
_STEP = 1 << 15


def _parted(values: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """Stable partition: first the values whose flag is not set."""
    out, at = np.empty_like(values), [0, zeros]
    for i in range(0, len(values), _STEP):
        part, flags = values[i : i + _STEP], ones[i : i + _STEP]
        for side, which in enumerate((~flags, flags)):
            got = part.take(np.flatnonzero(which))
            out[at[side] : at[side] + len(got)] = got
            at[side] += len(got)
    return out


def _merged(values: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """What ``_parted`` made ``values`` of."""
    out, at = np.empty_like(values), [0, zeros]
    for i in range(0, len(values), _STEP):
        part, flags = out[i : i + _STEP], ones[i : i + _STEP]
        for side, which in enumerate((~flags, flags)):
            places = np.flatnonzero(which)
            part[places] = values[at[side] : at[side] + len(places)]
            at[side] += len(places)
    return out


def build(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray, bits: int) -> bytes:
    """A shard file of ``ids``; ``ends`` has where each document ends in them."""
    n = len(ids)
    planes, zeros, cur = [], [], ids.astype("<u2" if bits <= 16 else "<u4")
    for level in range(bits - 1, -1, -1):
        ones = (cur & cur.dtype.type(1 << level)) != 0
        packed = np.packbits(ones, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)])
        counts = np.bitwise_count(packed.view("<u8")).reshape(-1, BLOCK // 64).sum(1)
        planes.append((packed, np.concatenate([[0], np.cumsum(counts)]).astype("<u4")))
        zeros.append(n - int(counts.sum()))
        cur = _parted(cur, ones, zeros[-1])
    nulls = sum(d is None for d in doc_ids)
    parts = [HEAD.pack(MAGIC, VERSION, bits, len(doc_ids), nulls, n), np.array(zeros, "<u8").tobytes()]
    parts += [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), ends.astype("<u8").tobytes()]
    for packed, directory in planes:
        parts += [packed.tobytes(), directory.tobytes()]
    return b"".join(parts)


class Shard:
    """A shard file, as bytes or any buffer of them."""

    def __init__(self, data):
        magic, version, self.bits, docs, self.nulls, self.n = HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a wavelet-matrix shard of this version")
        at = HEAD.size
        take = lambda kind, count: np.frombuffer(data, kind, count, at)
        self.zeros = take("<u8", self.bits).tolist()
        at += 8 * self.bits
        ids = take("<i8", docs)
        self.doc_ids = [None] * self.nulls + ids[self.nulls :].tolist()
        at += 8 * docs
        self.ends = take("<u8", docs)
        at += 8 * docs
        self.planes, self.directories = [], []
        blocks = -(-self.n // BLOCK)
        for _ in range(self.bits):
            self.planes.append(take(np.uint8, blocks * BLOCK // 8))
            at += blocks * BLOCK // 8
            self.directories.append(take("<u4", blocks + 1))
            at += 4 * (blocks + 1)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = divmod(i, BLOCK)
        if not rest:
            return int(self.directories[level][block])
        bits = self.planes[level][block * BLOCK // 8 : block * BLOCK // 8 + -(-rest // 8)]
        whole = int.from_bytes(bits.tobytes(), "little") & ((1 << rest) - 1)
        return int(self.directories[level][block]) + whole.bit_count()

    def _find(self, level: int, one: bool, k: int) -> int:
        """The place of the ``k``-th (from 0) one or zero of a plane."""
        directory = self.directories[level]

        def before(block: int) -> int:
            """Such bits before a block."""
            ones = int(directory[block])
            return ones if one else min(block * BLOCK, self.n) - ones

        block, end = 0, len(directory) - 1
        while end - block > 1:  # the last block with k or fewer before it
            middle = (block + end) // 2
            block, end = (middle, end) if before(middle) <= k else (block, middle)
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - before(block)])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            ones = self._ones(level, i)
            bit = self._ones(level, i + 1) - ones
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _interval(self, token: int, start: int, end: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self._ones(level, start), self._ones(level, end)
            if token >> (self.bits - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` is at places from ``start`` to before ``end``."""
        a, b = self._interval(token, start, self.n if end is None else end)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of the ``k``-th occurrence (from 0) of ``token``."""
        a, b = self._interval(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(self.bits - 1, -1, -1):
            one = bool(token >> (self.bits - 1 - level) & 1)
            i = self._find(level, one, i - self.zeros[level] if one else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def all(self) -> np.ndarray:
        """Every id, from the lowest plane up: each undoes one stable partition."""
        values = np.zeros(self.n, "<u2" if self.bits <= 16 else "<u4")
        for k in range(self.bits):
            level = self.bits - 1 - k
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            values[self.zeros[level] :] |= 1 << k
            values = _merged(values, ones, self.zeros[level])
        return values


# ----------------------------------------------------------------- the tokenizer

#: Of the first 256 code points, those that are letters in lower case, numbers, and neither space nor control.
_LOW, _NUM = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
#: What a text of the plain kind must not contain; and the words of its lower-cased form, as the tokenizer cuts them.
_NOT_PLAIN = re.compile("[^\t\n\v\f\r -~\xa1-\xff]|<\\|")
_WORD = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LOW}]+|[{_NUM}]|[^\\s{_LOW}{_NUM}]+")
#: A text whose words are letters, full stops and commas, if no two of the marks touch: splitting by space then does.
_SIMPLE = re.compile("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff \n.,]*")
_TOUCHING = (".  .", ".  ,", ",  .", ",  ,")
_CHUNK = re.compile(r"[^ \t\n\r\f\v]+")


class WordTokenizer(dict):
    """Encodes texts word by word, for tokenizers that lower-case, drop white space and never look across words.

    The dictionary has the ids of words met, as bytes; what it lacks the library works out.
    Texts of Latin-1 characters are cut into the tokenizer's own words, others into chunks
    between ASCII white space, which the library cuts further. When the table has
    ``TABLE_WORDS`` entries it becomes the older one, from which words come back as they are met.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if (got := self.older.get(word)) is None:
            got = array.array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= TABLE_CHARS:
            if len(self) >= TABLE_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = got
        return got

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        return [b"".join([*map(self.__getitem__, _words(text)), end]) for text in texts]


def _words(text: str) -> list[str]:
    if _SIMPLE.fullmatch(text):
        spaced = text.lower().replace(".", " . ").replace(",", " , ")
        if not any(x in spaced for x in _TOUCHING):
            return spaced.split()
    return _CHUNK.findall(text) if _NOT_PLAIN.search(text) else _WORD.findall(text.lower())


def _tokenizer(path: str) -> WordTokenizer:
    return kept("wavelet", (path,), lambda: WordTokenizer(path))


def _open_dir(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")


# ----------------------------------------------------------------- writing and reading


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, *, doc_id: str = "doc_id", text: str = "text", shard_mb: float = SHARD_MB, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode every text and write shards in ascending order of documents; returns the manifest.

    A task has one range of ``doc_id`` and cuts it into shards of about ``shard_ids`` ids, so shards
    and what a task holds stay as large whatever the input. A shard is written under a name of its own and then
    renamed, so a task that runs twice leaves one whole file. The manifest (a row for
    each shard: shard, path, n_docs, n_tokens) is kept beside the shards.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "shards")
    n = min(partitions_for(docs, shard_mb), MOST_PARTITIONS)
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), blank(text).alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, first = _tokenizer(tokenizer), TaskContext.get().partitionId() << 16
        bits = max(1, (max(coder.size - 1, end_id)).bit_length())
        fs, root = _open_dir(folder)
        fs.create_dir(root, recursive=True)
        ids, docs_of, sizes, shard, held = [], [], [], first, 0

        def written() -> pa.RecordBatch:
            data = build(np.concatenate(ids), docs_of, np.cumsum(sizes), bits)
            own, path = f"{root}/.{uuid.uuid4().hex}", f"{root}/shard-{shard:010d}.wvm"
            with fs.open_output_stream(own) as file:
                file.write(data)
            fs.move(own, path)
            return pa.RecordBatch.from_pylist([{"shard": shard, "path": f"{folder}/shard-{shard:010d}.wvm", "n_docs": len(docs_of), "n_tokens": int(sum(sizes))}], schema=_MANIFEST)

        for batch in text_batches(batches, "text"):
            coded = coder.encode(batch.column("text").to_pylist(), end)
            docs_of += batch.column("doc_id").to_pylist()
            sizes += [len(x) // 4 for x in coded]
            ids.append(np.frombuffer(b"".join(coded), "<u4").astype("<u2" if coder.size <= 1 << 16 else "<u4"))
            held += len(ids[-1])
            if held >= shard_ids:
                yield written()
                ids, docs_of, sizes, shard, held = [], [], [], shard + 1, 0
        if docs_of:
            yield written()

    ordered.mapInArrow(run, "shard long, path string, n_docs long, n_tokens long").write.parquet(f"{folder}/manifest")
    return spark.read.schema("shard long, path string, n_docs long, n_tokens long").parquet(f"{folder}/manifest")


_MANIFEST = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_documents(manifest: DataFrame, parallel: int | None = None) -> DataFrame:
    """From the shard files: doc_id, start (ids of all documents before), n_tokens, ids (u32, as binary).

    The ids of earlier shards are summed over the manifest, one small row for each shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = parallel or max(8, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = _open_dir(row["path"])
                with fs.open_input_file(path) as file:
                    shard = Shard(file.read_buffer())
                ids = shard.all()
                starts = [0, *shard.ends[:-1].tolist()]
                for a in range(0, len(starts), 1024):
                    ends = shard.ends[a : a + 1024].tolist()
                    parts = [ids[s:e].astype("<u4").tobytes() for s, e in zip(starts[a : a + 1024], ends, strict=True)]
                    at = [row["before"] + s for s in starts[a : a + 1024]]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[a : a + 1024], pa.int64()), pa.array(at, pa.int64()), pa.array([len(x) // 4 for x in parts], pa.int64()), pa.array(parts, pa.binary())], schema=_DOCS)

    return shards.select("path", "before", "shard").repartition(n, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
