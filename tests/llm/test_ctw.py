import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyline.llm import ctw


@pytest.fixture(autouse=True)
def few_blocks(monkeypatch):
    monkeypatch.setattr(ctw, "LEAST_BLOCKS", 4)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def symbols(text):
    """(context bytes nearest first, byte) of a text and its end."""
    data = [255] * ctw.DEPTH + [*low(text).encode(), 255]
    return [(tuple(data[i - 1 : i - 1 - ctw.DEPTH : -1] if i > ctw.DEPTH else data[i - 1 :: -1][: ctw.DEPTH]), data[i]) for i in range(ctw.DEPTH, len(data))]


def brute(rows):
    """The tree as dictionaries, weighted by recursion."""
    train = [(d, t) for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    nodes = {}
    for _, t in train:
        for context, byte in symbols(t):
            for k in range(8):
                node, bit = (1 << k) | byte >> (8 - k), byte >> (7 - k) & 1
                for d in range(ctw.DEPTH + 1):
                    nodes.setdefault((context[:d], node), [0, 0])[bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    weighted, inner = {}, Counter()
    for context, node in sorted(nodes, key=lambda x: -len(x[0])):
        own = kt(*nodes[context, node])
        value = own if len(context) == ctw.DEPTH else np.logaddexp(own, inner[context, node]) + math.log(0.5)
        weighted[context, node] = value
        if context:
            inner[context[:-1], node] += value
    counts = Counter()
    for _, t in train:
        counts.update([*re.findall(r"[^\x20\x09-\x0D]+", low(t)), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        total = 0.0
        for context, byte in symbols(t):
            for k in range(8):
                node, bit = (1 << k) | byte >> (8 - k), byte >> (7 - k) & 1
                p = None
                for depth in range(ctw.DEPTH, -1, -1):
                    if (held := nodes.get((context[:depth], node))) is not None:
                        own = (held[bit] + 0.5) / (sum(held) + 1)
                        share = math.exp(kt(*held) + math.log(0.5) - weighted[context[:depth], node])
                        p = own if p is None else share * own + (1 - share) * p
                total += math.log10(0.5 if p is None else p)
        tokens = [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((d, zlib.crc32(str(d).encode()) % 7 == 2, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, total, -total / math.log10(2) / len(symbols(t))))
    return out


def same(got, want):
    got, want = sorted(map(tuple, got)), sorted(want)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5, abs=1e-5) and g[7] == pytest.approx(w[7], rel=1e-5)


def test_scores_equal_brute_force(spark):
    rng = random.Random(3)
    syllables = ["the", "an", "Éa", "or ", " ", ".\n", "ing ", "\x00", "漢"]
    rows = [(i, "".join(rng.choices(syllables, k=rng.randrange(0, 40)))) for i in range(60)] + [(100, None), (101, ""), (102, "x" * 3000), (5, "the the"), (5, "the the")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    same(ctw.score(docs).collect(), brute(rows))
    assert ctw.score(docs.where("false")).count() == 0


def test_rows_without_ids_spread(spark):
    """Nine of ten rows have no id, and repeat it so: they are dealt by their texts."""
    rows = [(None if k % 10 else k, f"text {k % 97} of some kind" * (k % 4)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in ctw.score(docs).collect()]
    want = [(d, zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2) for d, _ in rows]
    assert sorted(map(str, (g[:2] for g in got))) == sorted(map(str, want))
    from tallyline.llm.common import deal

    placed = deal(docs.selectExpr("doc_id", "coalesce(text, '') text"), 16).selectExpr("block", "spark_partition_id() AS p").distinct().collect()
    assert len({r.p for r in placed}) == len({r.block for r in placed}) == len(placed) == 16
    sizes = [r.n for r in deal(docs.selectExpr("doc_id", "coalesce(text, '') text"), 16).groupBy("block").agg({"*": "count"}).toDF("block", "n").collect()]
    assert len(sizes) == 16 and max(sizes) < 150


def test_many_askers(spark, monkeypatch):
    rows = [(k, f"some words {k} " * (k % 5)) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, ctw.score(docs).collect()))
    monkeypatch.setattr(ctw, "ASKERS", 2)
    assert sorted(map(tuple, ctw.score(docs).collect())) == want


def test_without_learning_texts(spark):
    rows = [(d, "some text") for d in range(200) if zlib.crc32(str(d).encode()) % 7 == 2]
    got = ctw.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert all(r.train_tokens == r.n_known == 0 and r.score == pytest.approx(80 * math.log10(0.5)) and r.base_score == 0 for r in got)


def test_chances_of_all_bytes_sum_to_one():
    keys, counts = ctw.reduced(ctw.runs([b"abracadabra alakazam " * 3, b"banana"])[0])
    tree = ctw.Subtrees(keys, counts)
    top = ctw.top_tables(tree.top())
    for context in (keys[3] >> np.uint64(8), keys[-1] >> np.uint64(8), np.uint64(0x6162636465)):
        asked = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert (10 ** tree.log10(asked, top)).sum() == pytest.approx(1.0)


def test_query_is_better_than_its_base(spark):
    from tallyline.llm.queries import QUERIES

    rows = QUERIES["op3_context_tree"](spark, "/root/testdata/sf0.1").where("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)
