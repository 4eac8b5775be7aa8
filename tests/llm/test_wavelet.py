import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from tallyline.llm import wavelet

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def test_shards_are_cut_inside_a_task(spark):
    """Shards of a few ids each; what is read back does not depend on where they end. Select finds every place of a long plane."""
    rows = [(k % 37, f"word{k} and more of it " * (k % 6)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = P.path("word_bpe_49k.json")
    read = lambda n: sorted((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in wavelet.read_documents(wavelet.write(docs, path, 2, shard_ids=n)).collect())
    assert read(20) == read(1 << 24)
    rng = np.random.default_rng(1)
    ids = rng.choice([1, 5, 5, 5, 9], 20_000)
    shard = wavelet.Shard(wavelet.build(ids, [1], np.array([len(ids)]), 4))
    for token in (1, 5, 9):
        places = np.flatnonzero(ids == token)
        assert [shard.select(token, int(k)) for k in range(0, len(places), 97)] == places[::97].tolist()


def test_shard_answers():
    rng = random.Random(3)
    for n, bits in ((0, 3), (1, 1), (700, 4), (5000, 16), (1536, 17)):
        ids = [rng.randrange(1 << bits) for _ in range(n)]
        ends = np.array(sorted(rng.randrange(n + 1) for _ in range(4)) + [n])
        shard = wavelet.Shard(wavelet.build(np.array(ids, "<u4"), [None, None, 3, 4, 9], ends, bits))
        assert shard.all().tolist() == ids and shard.doc_ids == [None, None, 3, 4, 9] and shard.ends.tolist() == ends.tolist()
        for i in rng.sample(range(n), min(n, 60)):
            assert shard.access(i) == ids[i]
            a, b = sorted((rng.randrange(n + 1), rng.randrange(n + 1)))
            assert shard.count(ids[i], a, b) == ids[a:b].count(ids[i])
            assert shard.occurrences(ids[i]) == [k for k, x in enumerate(ids) if x == ids[i]]
        assert shard.count(1 << bits) == 0


def test_write_and_read(spark, tmp_path):
    rng = random.Random(4)
    alphabet = "abcdeé'st 0123\n\t\x0b\x85 　.,!ΣİßA漢"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(200)]
    texts += [None, "", "   ", "x" * 3000, "a b " * 4000, "<|endoftext|> it's é ́ ok", texts[0]]
    rows = [(i * 7 % 211, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, "same id"), (3, "same id")]
    docs = spark.createDataFrame([(t, d, 1) for d, t in rows], "text string, doc_id long, start int")
    got = wavelet.read_documents(wavelet.write(docs, PATH, 2, f"file://{tmp_path}/w", shard_mb=0.01)).collect()
    start = 0
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for row, (doc_id, text) in zip(sorted(got, key=lambda r: r.start), want, strict=True):
        ids = ids_of(text)
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids)), repr(text)
        assert np.frombuffer(row.ids, "<u4").tolist() == ids, repr(text)
        start += len(ids)


def test_empty_table(spark):
    assert wavelet.read_documents(wavelet.write(spark.createDataFrame([], "doc_id long, text string"), PATH, 2)).count() == 0


def test_query(spark):
    from tallyline.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op2_wavelet_shards"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for d in sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = np.array(ids_of(d.text), "<u4")
        r = rows.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not rows
