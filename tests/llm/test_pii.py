import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from tallyline.llm import pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in hit.split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def base(text):
    return [(m.start(), r, m.end(), k) for r, k in enumerate(pii.KINDS) for m in PLAIN[k].finditer(text or "") if valid(k, m.group())]


def secrets(text):
    """Runs of letters and digits that a key or token would be, judged one by one."""
    out = []
    for m in re.finditer(r"[0-9A-Za-z]+", text or ""):
        hit = m.group()
        has = lambda pattern: re.search(pattern, hit) is not None  # noqa: E731, B023
        if re.fullmatch("[0-9A-Fa-f]{32,}", hit) and has("[0-9]") and has("[A-Fa-f]") or len(hit) >= 24 and has("[0-9]") and has("[a-z]") and has("[A-Z]"):
            out.append((m.start(), 4, m.end(), "secret"))
    return out


def brute(texts):
    """Every span of every text, by counting over Python objects."""
    term = re.compile(r"[^\W\d_]{3,}")
    near, per, hidden = [], [], []
    for i, t in enumerate(texts):
        per.append(sorted(base(t)))
        hidden.append(secrets(t))
        for start, _, stop, kind in per[-1] + hidden[-1]:
            hit = t[start:stop]
            entity = kind + " " + (hit.lower() if kind in ("email", "ip", "secret") else re.sub("[^0-9]", "", hit))
            a = max(0, start - pii.WINDOW)
            b = min(len(t), stop + pii.WINDOW)
            for m in term.finditer(t):
                if a <= m.start() and m.end() <= b and (m.end() <= start or m.start() >= stop):
                    if (m.start() > a or a == 0) and (m.end() < b or b == len(t)):
                        near.append((i, entity, t[a:b].lower(), m.group().lower(), m.start(), m.end()))
    n_e, n_both, n_t = {}, {}, {}
    for _, e, w, t, *_ in near:
        n_e.setdefault(e, set()).add(w)
        n_both.setdefault((e, t), set()).add(w)
    for t in texts:
        for w in {m.group().lower() for m in term.finditer(t or "")}:
            n_t[w] = n_t.get(w, 0) + 1
    marked = {}
    n = len(texts)
    for i, e, _, t, start, stop in near:
        both = len(n_both[e, t])
        if both >= pii.SUPPORT and n > len(n_e[e]):
            share = math.log(min(both, n_t[t]) * n / (n_t[t] * len(n_e[e]))) / math.log(n / len(n_e[e]))
            if share >= pii.GENERALISE:
                marked.setdefault(i, {}).setdefault((start, stop), []).append(share)
    out = []
    for i, spans in enumerate(per):
        more = [(a, 5, b, "drop" if max(s) >= pii.REMOVE else "term") for (a, b), s in marked.get(i, {}).items() if not any(x < b and a < y for x, _, y, _ in spans + hidden[i])]
        out.append((spans, sorted(more + hidden[i])))
    return out


def corpus():
    rng = random.Random(8)
    words = ["alpha", "bravo", "charlie", "delta", "écho", "漢字漢", "to", "x1"]
    out = [None, "", "a@b.c", "x" * 3000 + "@", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.0.9", "a@b.com_x@y.zz@q.r", "é 4111 1111 1111 1111, 4111-1111-1111-1112", "+1 (377) 555-0271 +12 +1-2", "1 2 " * 20000, "😀 a@b.co 😀 +49 30 1234567", "9" * 25, "%+-@a-.b@c.d", "12345678901234567890 1 1"]
    alphabet = "ab1209 .@-+()%é"
    out += ["".join(rng.choices(alphabet, k=rng.randrange(90))) for _ in range(300)]
    for k in range(40):
        fill = lambda: " ".join(rng.choices(words, k=6))
        out.append(f"{fill()} {["Zorbulon", "quixnar", "velmora"][k % 3]} wrote from secret.{k % 3}@mail.example.com {fill()} {k}")
        out.append(f"{fill()} and wrote {k}")
    for k in range(12):
        out.append(f"{fill()} api_key = \"{['0123456789abcdef' * 2, 'A1b2' * 8, '00ff' * 12, 'deadbeef' * 5, '1' * 40, 'f' * 40][k % 6]}\" Vexilar said {fill()} {k}")
    return out + [out[-2], out[-2]]


def test_spans_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    got = {r.doc_id: r for r in pii.spans(docs).collect()}
    want = brute(texts)
    assert len(got) == len(texts)
    for i, (spans, more) in enumerate(want):
        assert [tuple(s) for s in got[i].base] == spans, texts[i]
        assert [tuple(s) for s in got[i].terms] == more, texts[i]
    assert any(m for _, m in want)


def test_copies_count_once_on_both_sides_of_the_share(spark):
    other = "and more of the same prose " * 8
    texts = ["Zorbulon wrote from z@mail.example.com today"] * 1000 + ["again Zorbulon answered z@mail.example.com"]
    texts += [f"Quixnar wrote from q@mail.example.com {other} {k}" for k in range(200)] + [f"again Quixnar answered q@mail.example.com {other}"]
    texts += [f"today somebody wrote and answered again {k}" for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spans(docs).collect():
        marked = {texts[r.doc_id][s.start : s.stop]: s.kind for s in r.terms}
        if r.doc_id < 1001:
            assert marked["Zorbulon"] == "drop" and not {"wrote", "today", "again", "answered"} & marked.keys()
        elif r.doc_id < 1202:
            assert marked["Quixnar"] == "drop" and not {"wrote", "again", "answered"} & marked.keys()
        else:
            assert not marked


def test_sanitise_keeps_rows_and_columns(spark):
    key = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    assert pii.sanitise(spark.createDataFrame([(1, f'token="{key}" end {key}')], "doc_id long, text string")).first().text == 'token="[SECRET]" end [SECRET]'
    rows = [(1, "mail a@b.co or 10.0.0.1 now", "k"), (2, None, None), (2, None, None), (None, "", "k"), (3, "plain", "k"), (1, "mail a@b.co or 10.0.0.1 now", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([(1, "mail [EMAIL] or [IP] now", "k"), (2, None, None), (2, None, None), (None, "", "k"), (3, "plain", "k"), (1, "mail [EMAIL] or [IP] now", "k")], key=str)
    assert pii.sanitise(docs.where("false")).count() == 0


def test_query(spark):
    from tallyline.llm.queries import QUERIES

    rows = QUERIES["op10_disclosure_pii"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        spans = sorted(base(texts[r.doc_id]))
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.n_secret == len(secrets(texts[r.doc_id])) and r.n_spans == len([s for s in r.spans.split(",") if s])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in pii.KINDS]
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))
