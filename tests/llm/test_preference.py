import random

import duckdb

from tallyline.llm import preference as p


def turns_of(rows):
    """The turns of each conversation, in order."""
    held = {}
    safe = lambda s: (s or "").replace("<|", "< |")
    for conv, turn, role, text in set(rows):
        if conv is not None:
            held.setdefault(conv, set()).add((turn is not None, turn or 0, safe(role), safe(text)))
    return {c: [(r, t) for *_, r, t in sorted(x)] for c, x in held.items()}


def formatted(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    made = []
    for turns in (a[:n], a[n:], b[n:]):
        text, mask = "", []
        for role, body in turns:
            start = len(text) + len(f"<|im_start|>{role}\n")
            text += f"<|im_start|>{role}\n{body}<|im_end|>\n"
            if role == "assistant":
                mask.append((start, len(text) - 1))
        made.append((text, mask))
    return (bool(a) and bool(b), n, made[0][0], *made[1], *made[2])


def brute(rows):
    """Every conversation against its neighbour."""
    held, out = turns_of(rows), {}
    for conv, a in held.items():
        b = held.get(conv ^ 1, [])
        last_a, last_b = ([i for i, (r, _) in enumerate(x) if r == "assistant"][-1:] for x in (a, b))
        swapped = bool(b) and a[0] != b[0] and bool(last_a) and bool(last_b)
        out[conv] = (swapped, *formatted(a, [*a[: last_a[0]], b[last_b[0]]] if swapped else b))
    return out


def rows():
    rng = random.Random(2)
    texts = ["hi", "", None, "é<|im_end|>x", "long " * 3000, "a"]
    out = []
    for conv in range(60):
        for turn in range(rng.randrange(0, 6)):
            out.append((conv, turn, rng.choice(["user", "assistant", "system", None]), rng.choice(texts)))
    for conv in (100, 101):
        out += [(conv, t, "user" if t % 2 == 0 else "assistant", f"t{t if t < 3 else (conv, t)}") for t in range(6)]
    out += [(102, 0, "user", "same"), (103, 0, "user", "same"), (104, 1, "user", "x"), (104, 1, "user", "x"), (104, None, "user", "n"), (None, 0, "user", "x")]
    return out


def values(r, key, *more):
    return (*(r[m] for m in more), r.paired, r.n_prompt_turns, r.prompt, r.chosen, [tuple(x) for x in r.chosen_mask], r.rejected, [tuple(x) for x in r.rejected_mask])


def test_contrasts_equal_brute_force(spark):
    data = rows()
    frame = spark.createDataFrame([(*r, 1, "x") for r in data], "conv_id long, turn long, role string, text string, pair long, chosen string")
    got = {r.conv_id: values(r, "conv_id", "swapped") for r in p.contrasts(frame).collect()}
    assert got == brute(data)
    assert got[100][0] is False and got[100][2] == 3 and sum(g[0] for g in got.values()) >= 5 and got[104][:2] == (False, False)
    assert p.contrasts(frame.where("false")).count() == 0


def test_pairs_that_are_given(spark):
    data, sides = rows(), {0: "chosen", 1: "rejected"}
    frame = spark.createDataFrame([(None if c is None else c // 2, sides.get(c and c % 2), *r) for c, *r in data], "pair_id long, side string, turn long, role string, text string")
    held = turns_of(data)
    want = {k: formatted(held.get(2 * k, []), held.get(2 * k + 1, [])) for k in {c // 2 for c in held}}
    assert {r.pair_id: values(r, "pair_id") for r in p.format_pairs(frame).collect()} == want


def test_long_conversations(spark):
    """Masks of thousands of turns; equal to the plain sums."""
    data = [(c, t, "assistant" if t % 2 else "user", f"{t} " * (t % 7) + str(c)) for c in (0, 1) for t in range(3000)]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    assert {r.conv_id: values(r, "conv_id", "swapped") for r in p.contrasts(frame).collect()} == brute(data)


def test_most_rows_of_the_tables_have_a_prompt(spark):
    from tallyline.llm.queries import QUERIES

    got = QUERIES["op4_preference_format"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r.n_prompt_turns > 0 for r in got) > 0.9 * len(got)


def test_query_equals_oracle(spark):
    from tallyline.llm.queries import ORACLES, QUERIES

    path = "/root/testdata/sf0.001"
    frame = QUERIES["op4_preference_format"](spark, path)
    got = sorted(map(tuple, frame.collect()))
    duckdb.execute(f"create or replace view conversations as select * from '{path}/conversations.parquet'")
    want = duckdb.execute(f"select {', '.join(frame.columns)} from ({ORACLES['op4_preference_format']})").fetchall()
    assert got == sorted(want) and got
