import random

from tallyline.llm import decontaminate as d


def sellers(item, text):
    """Fewest edits between item and any substring of text, by the plain table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([[], ["x"], [out[k], "y"]])
    return "".join(out)


def cases():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randrange(2, 9)))
    make = lambda n: d.plain(" ".join(word() for _ in range(n)))
    items = [make(n) for n in (3, 8, 20, 40, 60)] + ["ab", "aaaa aaaa aaaa aaaa aaaa aaaa aaaa"]
    texts = [None, "", " \n ", "a" * 4000]
    for _ in range(120):
        item = rng.choice(items)
        noise = rng.randrange(0, 3 + len(item) // 10)
        texts.append(f"{make(rng.randrange(30))} {edited(rng, item, noise).upper()} \n\t {make(rng.randrange(30))}")
    texts += [make(rng.randrange(60)) for _ in range(40)] + [items[3]] * 3
    return items, texts


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "an exact benchmark item stands here", "kept", 7), (2, "nothing", "kept", 8)], "doc_id long, text string, __text string, start int")
    items = spark.createDataFrame([(5, "exact benchmark item")], "item_id long, text string")
    assert [tuple(r) for r in d.clean(docs, items).collect()] == [(2, "nothing", "kept", 8)]
    [row] = d.matches(docs, items, keep=("doc_id", "start", "__text")).collect()
    assert row.asDict() == {"doc_id": 1, "doc_start": 7, "__text": "kept", "item_id": 5, "edits": 0, "start": 3, "stop": 23}


def test_matches_equal_brute_force(spark):
    items, texts = cases()
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    bench = spark.createDataFrame([(i, t, None) for i, t in enumerate([*items, None, " "])], "item_id long, text string, edits string")
    got = {(r.doc_id, r.item_id): r for r in d.matches(docs, bench).collect()}
    want = {}
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            edits = sellers(item, d.plain(t))
            if d.plain(t) and edits <= len(item) // d.PER_EDIT:
                want[i, k] = edits
    assert {k: r.edits for k, r in got.items()} == want
    assert 0 < sum(e > 0 for e in want.values())
    for (i, k), r in got.items():
        part = d.plain(texts[i])[r.start : r.stop]
        assert abs(len(part) - len(items[k])) <= r.edits and sellers(items[k], part) == r.edits
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(texts)) if not any(a == i for a, _ in want)]


def test_blocks_and_empty_tables(spark, monkeypatch):
    items, texts = cases()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, d.matches(docs, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_CHARS", 100)
    assert sorted(map(tuple, d.matches(docs, bench).collect())) == whole
    assert d.matches(docs.where("false"), bench).count() == d.matches(docs, bench.where("false")).count() == 0
    assert d.clean(docs, bench.where("false")).count() == len(texts)


def test_query_finds_planted_items(spark):
    from tallyline.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_pigeonhole_decontaminate"](spark, path).collect()}
    docs = [(r.doc_id, d.plain(r.text)) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    exact = {(i, r.item_id) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect() for i, t in docs if d.plain(r.text) in t}
    assert exact and exact <= got
