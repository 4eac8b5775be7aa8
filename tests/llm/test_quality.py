import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyline.llm import ngram_llr, rff, textstats


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    marked = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def texts():
    rng = random.Random(4)
    vocab = ["a", "b", "é", "##", "x|y", "　z", "漢<字", "\x1c", "."]
    made = [rng.choice(["", " "]) + "".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for _ in range(rng.randrange(120))) for _ in range(200)]
    return ["", " \n\t", "a", "a a a a", "a b c a b c", "word " * 20_000, "x" * 50_000, *made]


def test_base_counts():
    for text in texts():
        assert textstats.base_counts(text) == plain_counts(text)


def test_features_are_finite():
    for text in texts():
        got = textstats.features(text)
        assert len(got) == len(textstats.FEATURES) and np.isfinite(got).all()


def test_ratio_equals_brute_force(spark):
    rows = [(i, t, "y") for i, t in enumerate([None, *texts()])] + [(None, "null id text", "n"), (3, "a a a", "n"), (3, "a a a", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(60)] + [(3, 1, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    assert sorted({r.doc_id for r in ngram_llr.training(labels).collect()}) == [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    ids = ngram_llr.trusted(labels)
    assert ids.tolist() == list(range(0, 60, 3))
    learned = ngram_llr.weights(docs, ids)
    size = ngram_llr.BUCKETS
    counts = np.zeros((2, size))
    grams = {}
    for k, (i, t, _) in enumerate(rows):
        raw = (t or "").encode()
        grams[k] = [int.from_bytes(raw[j : j + 4], "little") * 0x9E3779B1 % 2**32 >> 18 for j in range(len(raw) - 3)]
        for g in grams[k]:
            counts[0, g] += 1
            counts[1, g] += i in set(ids.tolist())
    want = np.log((counts[1] + 1) / (counts[1].sum() + size)) - np.log((counts[0] + 1) / (counts[0].sum() + size))
    assert np.allclose(learned, want)
    cut = float(np.median(learned))
    got = sorted(map(tuple, ngram_llr.judge(docs, learned, threshold=cut).collect()), key=str)
    expected = []
    for k, (i, t, _) in enumerate(rows):
        base = plain_counts(t or "")
        score = float(np.mean([want[g] for g in grams[k]])) if grams[k] else 0.0
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        expected.append((i, *base, failed, score, not failed and score >= cut))
    for g, e in zip(got, sorted(expected, key=str), strict=True):
        assert g[:7] == e[:7] and g[7] == pytest.approx(e[7], abs=1e-9) and g[8] == e[8]


def test_every_good_label_counts(spark, monkeypatch):
    labels = spark.range(25_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    ids = ngram_llr.trusted(labels)
    assert ids.tolist() == list(range(25_000))
    docs = spark.createDataFrame([(k, f"text {k} of its own" * (k % 5)) for k in range(24_900, 25_100)] + [(None, "no id"), (24_950, "again")], "doc_id long, text string")
    monkeypatch.setattr(ngram_llr, "HELD_IDS", 10)
    table = ngram_llr.trusted(labels)
    assert not isinstance(table, np.ndarray) and np.allclose(ngram_llr.weights(docs, table), ngram_llr.weights(docs, ids))
    assert not np.allclose(ngram_llr.weights(docs, table), ngram_llr.weights(docs, ids[:0]))


def test_threshold_parts_labelled_texts_best(spark):
    rng = random.Random(5)
    kinds = (["uno", "due", "tre"], ["xx", "yy", "#z"])
    rows = [(k, " ".join(rng.choice(kinds[k % 2 if k % 7 else 0]) + rng.choice("abcdefghijk") + rng.choice("lmnopqrstuv") for _ in range(60)) + f" {k}") for k in range(120)] + [(None, "no id"), (200, None), (201, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 2 == 0)) for k in range(120)] + [(200, 0), (201, 1), (None, 1), (500, 0)], "doc_id long, quality int")
    learned = ngram_llr.weights(docs, ngram_llr.trusted(labels))
    cut = ngram_llr.threshold(docs, learned, labels)
    scored = [(r.llr, r.doc_id % 2 == 0) for r in ngram_llr.judge(docs, learned).collect() if r.doc_id is not None and r.doc_id < 120]
    gain = lambda c: sum(s < c for s, g in scored if not g) / 60 - sum(s < c for s, g in scored if g) / 60
    assert gain(cut) >= max(gain(s + d) for s, _ in scored for d in (-1e-9, 1e-9)) - 0.02
    assert ngram_llr.threshold(docs, learned, labels.where("quality = 1")) == ngram_llr.threshold(docs.where("false"), learned, labels) == ngram_llr.THRESHOLD
    bad, good = np.zeros(ngram_llr.BINS), np.zeros(ngram_llr.BINS)
    bad[100], good[300], good[50] = 9, 20, 1
    assert ngram_llr.best_cut(bad, good) == pytest.approx((101 + 300) / 2 / ngram_llr.BINS * 16 - 8)


def test_threshold_counts_every_labelled_text(spark):
    """Of 24,000 labelled texts the last 4,000 by their hashes decide where the cut lies."""
    text = {c: " ".join(f"{c}{k:02}" for k in range(60)) for c in "gbl"}  # good, bad, bad and late
    ids = [r.id for r in spark.sql("SELECT id FROM range(24000) ORDER BY xxhash64(id), id").collect()]
    kind = {i: "l" if k >= 20_000 else "gb"[i % 2] for k, i in enumerate(ids)}
    docs = spark.createDataFrame([(i, text[c]) for i, c in kind.items()] + [(7, text[kind[7]]), (None, text["l"]), (99_999, text["g"])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(c == "g")) for i, c in kind.items()] + [(None, 1)], "doc_id long, quality int")
    learned = np.zeros(ngram_llr.BUCKETS)
    for c, value in (("b", -2), ("l", 1), ("g", 2)):
        learned[ngram_llr.buckets(text[c].encode())] = value
    ratio = {c: float(learned[ngram_llr.buckets(t.encode())].mean()) for c, t in text.items()}
    cut = ngram_llr.threshold(docs, learned, labels)
    assert ratio["l"] < cut < ratio["g"]
    counts = np.zeros((2, ngram_llr.BINS))
    for c in [*kind.values(), kind[7]]:
        counts[int(c == "g"), int((ratio[c] + 8) / 16 * ngram_llr.BINS)] += 1
    assert cut == ngram_llr.best_cut(*counts)
    got = ngram_llr.verdicts(docs, learned, labels).groupBy("doc_id").agg({"kept": "max"}).collect()
    assert {r[0]: r[1] for r in got} == {i: c == "g" for i, c in kind.items()} | {None: False, 99_999: True}


def plain_isotonic(good, total):
    """The rising fit as the largest, over starts, of the least mean to any end."""
    held = [k for k in range(len(total)) if total[k]]
    mean = lambda a, b: sum(good[k] for k in held[a : b + 1]) / sum(total[k] for k in held[a : b + 1])
    fit = [max(min(mean(a, b) for b in range(i, len(held))) for a in range(i + 1)) for i in range(len(held))]
    return np.interp(range(len(total)), held, fit) if held else np.full(len(total), 0.5)


def test_scores_equal_plain_least_squares(spark):
    """Every step again: features, moments, cosines, ridge by either half and both, pooling, look-up."""
    path = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    half = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 2) AS h").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    x = {d: np.array(textstats.features(t or "")) for d, t in texts.items()}
    train = [(r.doc_id, float(r.quality)) for r in labels.collect() if r.quality is not None and r.doc_id in x and zlib.crc32(str(r.doc_id).encode()) % 5]
    rows, y, side = np.array([x[d] for d, _ in train]), np.array([q for _, q in train]), np.array([half[d] for d, _ in train])
    mean, scale = rows.mean(0), rows.std(0) + 1e-9
    rng = np.random.default_rng(rff.SEED)
    directions, phases = rng.normal(size=(rff.N, rff.DIM)) / rff.WIDTH, rng.uniform(0, 2 * np.pi, rff.DIM)

    def cosines(values):
        z = np.clip((values - mean) / scale, -rff.REACH, rff.REACH)
        return np.hstack([np.sqrt(2 / rff.DIM) * np.cos(z @ directions + phases), np.ones((len(values), 1))])

    def ridge(which):
        a = np.vstack([cosines(rows[which]), np.sqrt(rff.RIDGE) * np.eye(rff.DIM + 1)])
        return np.linalg.lstsq(a, np.concatenate([y[which], np.zeros(rff.DIM + 1)]), rcond=None)[0]

    place = lambda raw: np.clip((raw + 0.5) / 2 * rff.BINS, 0, rff.BINS - 1).astype(int)
    apart = np.where(side == 0, cosines(rows) @ ridge(side == 1), cosines(rows) @ ridge(side == 0))
    steps = plain_isotonic(np.bincount(place(apart), y, rff.BINS), np.bincount(place(apart), minlength=rff.BINS))
    beta = ridge(side >= 0)
    got = {r.doc_id: r.score for r in rff.classify(docs, labels).collect()}
    near = [abs(got[d] - steps[place(cosines(x[d][None]) @ beta)[0]]) for d in x]
    assert len(got) == len(x) and sum(n > 1e-6 for n in near) <= 2  # a raw score may lie on the edge of a bin


def test_isotonic_equals_plain_pooling():
    rng = np.random.default_rng(2)
    for _ in range(50):
        total = rng.integers(0, 4, 30).astype(float)
        good = np.minimum(total, rng.integers(0, 4, 30))
        fit = rff.isotonic(good, total)
        assert (np.diff(fit) >= -1e-12).all() and 0 <= fit.min() and fit.max() <= 1
        held = total > 0
        assert np.allclose(fit, plain_isotonic(good, total))
        if held.any():  # the best rising fit keeps the weighted mean and beats any constant
            assert np.isclose((fit[held] * total[held]).sum(), good[held].sum())
    assert (rff.isotonic(np.zeros(5), np.zeros(5)) == 0.5).all()


def test_classifier_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    scored = rff.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum((r.score >= 0.3) == (r.quality == 1) for r in scored)
    assert len(scored) > 50 and right >= 0.95 * len(scored)
    assert all(0 <= r.score <= 1 for r in scored)


def test_classifier_on_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "some text here."), (None, "x"), (3, "some text here.")]
    docs = spark.createDataFrame([(*r, 0.1, "x") for r in rows], "doc_id long, text string, score double, y string")
    for marks in ([], [(1, None)], [(3, 1), (3, 0), (None, 1), (99, 0)]):
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        got = rff.classify(docs, labels).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert rff.classify(docs.where("false"), labels).count() == 0
    assert ngram_llr.judge(docs.where("false"), np.zeros(ngram_llr.BUCKETS)).count() == 0


def test_rules_keep_good_rows(spark):
    from tallyline.llm.queries import QUERIES

    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    rows = QUERIES["op7_ngram_llr"](spark, path).join(labels, "doc_id").where("not base_failed").collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % ngram_llr.FOLDS == 0]  # labels that nothing was learned from
    assert len(rows) > 40
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(r.kept for r in bad) <= 0.1 * len(bad)
