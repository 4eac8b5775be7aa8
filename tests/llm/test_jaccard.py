import random
import re

import duckdb
import pytest

from tallyline.llm import graph, jaccard


@pytest.fixture(autouse=True)
def few_blocks(monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_BLOCKS", 5)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or (frozenset([tuple(words)]) if words else frozenset())


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [(d, s) for d, s in sets if d is not None and s]
    for i, (d, s) in enumerate(live):
        for e, t in live[:i]:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "é", "　x"]
    make = lambda n: rng.choices(vocab, k=n)
    passage = make(60)
    rows, base = [], [make(rng.choice([3, 5, 7, 8, 9, 12, 20, 40, 150, 400])) for _ in range(30)]
    for b in base:
        for _ in range(rng.randrange(1, 6)):
            words = list(b)
            for _ in range(rng.randrange(0, 1 + max(1, len(b) // 25))):
                k = rng.randrange(max(1, len(words)))
                words[k : k + 1] = rng.choice([[], make(1), [words[k], *make(1)]])
            rows.append(rng.choice([" ", "\n", "\t "]).join(words))
    rows += [" ".join([*make(rng.randrange(5, 30)), *passage]) for _ in range(40)]
    rows += [" ".join(make(n % 9)) for n in range(30)] + ["A b C d E f g h", "a B c D e F g h", None, "", " \n", "one " * 50, "one " * 60, "x" * 5000, rows[0], rows[0]]
    rng.shuffle(rows)
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n int")
    assert sorted(map(tuple, jaccard.join(docs).collect()), key=str) == brute(rows)


def test_rounds_sizes_nulls_and_repeated_ids(spark, monkeypatch):
    rows = corpus(3)
    rows += [(None, "a b c d e f"), (None, None), (rows[0][0], rows[5][1]), (rows[1][0], "another text with some more words in it"), rows[2], rows[2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert sorted(map(tuple, jaccard.join(docs).collect()), key=str) == want
    monkeypatch.setattr(graph, "FEW", 0)
    assert sorted(map(tuple, jaccard.join(docs).collect()), key=str) == want
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard, "_boundary", lambda entries, sets: 30)
    assert sorted(map(tuple, jaccard.join(docs).collect()), key=str) == want
    assert jaccard.join(docs.where("false")).count() == 0


def test_rows_without_ids(spark):
    rows = [(None if k % 10 else k, " ".join(f"w{(k * j) % 13}" for j in range(9))) for k in range(300)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, component_id int")
    assert sorted(map(tuple, jaccard.join(docs).collect()), key=str) == brute(rows)


def test_boundary_by_cost_and_lists_that_grow_with_their_rows(spark):
    """Small sets list pairs where that is no dearer; a group of near copies costs rows in proportion to its size, not its square."""
    shape = "doc long, n int, shared array<long>, prefix array<long>, first int"
    small = [(k, 4, [1, 2, 3, k], [1, 2], 1) for k in range(9, 29)]
    for large, want in ((None, 4), ([7, 8, 10, 11, 12], 4), ([1, 7, 8, 10, 11], 0)):  # a list with a large set is scanned whatever the small ones do
        tiny = spark.createDataFrame(small + ([(d, 400, large, large, 4) for d in (98, 99)] if large else []), shape)
        assert jaccard._boundary(tiny.selectExpr("doc", "n", "first", "posexplode(prefix) as (pos, h)"), tiny) == want
    rng = random.Random(6)
    base = [f"w{i}" for i in range(48)]
    kept = []
    for size in (50, 200, 800):
        rows = []
        for k in range(size):
            words = list(base)
            words[rng.randrange(48)] = f"x{k % 40}"
            rows.append((k, " ".join(words)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        sets = jaccard.digests(docs).where("own").selectExpr("doc_id as doc", "n", "shared", "prefix", "first").dropDuplicates(["prefix", "n"]).cache()
        entries = sets.selectExpr("doc", "n", "first", "posexplode(prefix) as (pos, h)")
        kept.append(jaccard._differing(jaccard._lists(entries, sets, jaccard._boundary(entries, sets))).count())
        assert {r.component_id for r in jaccard.join(docs).collect()} == {0}
    assert kept[2] <= 5 * kept[1] + 200


@pytest.mark.parametrize("few", [0, 1 << 14])
def test_components_of_paths_and_stars(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    rng = random.Random(4)
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    order = list(range(200, 260))
    rng.shuffle(order)
    long = list(zip(order, order[1:], strict=False))
    frame = spark.createDataFrame(path + star + long + [(7, 7)], "a long, b long")
    got = {r.node: r.component for r in graph.components(frame).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in range(200, 260)}
    assert graph.components(frame.where("false")).count() == 0


def test_query_equals_brute_force(spark):
    from tallyline.llm.queries import ORACLES, QUERIES

    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op5_jaccard_join"](spark, path).collect()), key=str)
    assert got == brute(rows)
    duckdb.execute(f"create or replace view documents as select * from '{path}/documents.parquet'")
    assert got == sorted(duckdb.execute(ORACLES["op5_jaccard_join"]).fetchall(), key=str)
