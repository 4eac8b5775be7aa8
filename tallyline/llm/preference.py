"""Preference formatting: one prompt, two masked completions.

Chosen and rejected conversations share their longest common prefix of turns (equal
role and text). It is rendered once as the prompt; what follows is rendered as the
chosen and the rejected completion, each with the character spans that a loss should
count: the text and end mark of assistant turns.

A turn is ``<|im_start|>role``, a line break, its text, ``<|im_end|>`` and a line
break. In roles and texts ``<|`` becomes ``< |``, so no text can forge a mark.

Everything is one grouping by pair, in DataFrame functions: turns are gathered for the
one row that must hold them, and compared in place.

Tables of conversations carry no preference; ``contrasts`` says which are held against each other.

Defined results: rows that repeat exactly are one turn; turns of one number are ordered
by role and text; null roles and texts are empty, null turn numbers come first;
conversations of null id are left out; a side without turns has an empty completion and
``paired`` is false; equal sides give two empty completions; an empty table gives no
row. Columns besides the four are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions

START, END = "<|im_start|>", "<|im_end|>"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def _safe(column: str) -> Column:
    return F.replace(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + "\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """Spans (start, stop) of assistant texts with their end mark, in the rendered turns."""

    def span(at, turn):
        start = at + len(START) + F.char_length(turn["role"]) + 1
        return F.struct(start.alias("start"), (start + F.char_length(turn["text"]) + len(END)).alias("stop"), (turn["role"] == "assistant").alias("counts"))

    every = positions(turns, lambda t: F.char_length(_rendered(t)), span, "struct<start:int,stop:int,counts:boolean>")
    return F.transform(F.filter(every, lambda s: s["counts"]), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))


def _gathered(rows: DataFrame, key: str, sides: dict[str, Column]) -> DataFrame:
    """For each ``key`` that is not null the turns of each side, in order, as arrays of (role, text)."""
    one = F.struct(F.col("turn").cast("long").alias("turn"), _safe("role").alias("role"), _safe("text").alias("text"))
    sets = {s: F.array_sort(F.collect_set(F.when(which, one))).cast(_TURNS) for s, which in sides.items()}
    bare = {s: F.transform(s, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))) for s in sides}
    got = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*(c.alias(s) for s, c in sets.items()))
    return got.select(key, *(b.alias(s) for s, b in bare.items()))


def _formatted(pairs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """From ``keep`` and the turns ``chosen`` and ``rejected``: the common prefix as prompt, the rest as completions."""
    sides = ("chosen", "rejected")
    pairs = pairs.withColumn("paired", (F.size("chosen") > 0) & (F.size("rejected") > 0))
    least = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(F.slice("chosen", F.lit(1), least), F.slice("rejected", F.lit(1), least), lambda a, b: a == b)
    first = F.array_position(same, F.lit(False)).cast("int")
    pairs = pairs.withColumn("n", F.when(first > 0, first - 1).otherwise(least))
    rest = {s: F.slice(F.col(s), F.col("n") + 1, F.greatest(F.size(s) - F.col("n"), F.lit(0))) for s in sides}
    pairs = pairs.select(*keep, "paired", "n", F.slice("chosen", F.lit(1), F.col("n")).alias("turns"), *(r.alias(f"turns_{s}") for s, r in rest.items()))
    return pairs.select(
        *keep, "paired", F.col("n").cast("long").alias("n_prompt_turns"), _render(F.col("turns")).alias("prompt"),
        *(c for s in sides for c in (_render(F.col(f"turns_{s}")).alias(s), _mask(F.col(f"turns_{s}")).alias(f"{s}_mask"))),
    )


def format_pairs(turns: DataFrame) -> DataFrame:
    """From rows (pair_id, side, turn, role, text), side being ``chosen`` or ``rejected``.

    Returns pair_id, paired, n_prompt_turns, prompt, and for either side its completion and mask.
    """
    return _formatted(_gathered(turns, "pair_id", {s: F.col("side") == s for s in ("chosen", "rejected")}), ("pair_id",))


def contrasts(conversations: DataFrame) -> DataFrame:
    """Every conversation as chosen, against its neighbour: 2k and 2k + 1 are neighbours.

    Neighbours with the same first turn are answers to one history: the neighbour is the rejected side. Others
    share none, so the rejected side is made (``swapped``): the conversation's turns before its last
    assistant turn, then the last assistant turn of the neighbour. Where one of the two has no assistant
    turn, the neighbour is the rejected side as it is; without a neighbour it is empty.
    """
    odd = F.pmod(F.col("conv_id"), F.lit(2)) == 1
    both = _gathered(conversations.withColumn("pair", F.shiftright(F.col("conv_id").cast("long"), 1)), "pair", {"even": ~odd, "odd": odd})

    def last(turns):
        """The place of the last assistant turn, 0 if there is none."""
        return F.coalesce(F.array_max(F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", i + 1))), F.lit(0))

    both = both.withColumns({"last_even": last(F.col("even")), "last_odd": last(F.col("odd"))})

    def side(own, other, conv):
        x, y, at, to = F.col(own), F.col(other), F.col(f"last_{own}"), F.col(f"last_{other}")
        swapped = F.coalesce((F.try_element_at(x, F.lit(1)) != F.try_element_at(y, F.lit(1))) & (at > 0) & (to > 0), F.lit(False))
        made = F.concat(F.slice(x, F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(y, F.greatest(to, F.lit(1)), F.lit(1)))
        return F.struct(conv.alias("conv_id"), swapped.alias("swapped"), x.alias("chosen"), F.when(swapped, made).otherwise(y).alias("rejected"))

    pair = F.col("pair") * 2
    each = both.select(F.explode(F.array(side("even", "odd", pair), side("odd", "even", pair + 1))).alias("c")).select("c.*")
    return _formatted(each.where(F.size("chosen") > 0), ("conv_id", "swapped"))


def mask_text(mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",")


#: The query over contrasts in SQL that DuckDB runs.
ORACLE = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, replace(coalesce(role, ''), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), v AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS x FROM t GROUP BY conv_id
), w AS (
  SELECT conv_id, x, coalesce(list_max([i FOR i IN range(1, len(x) + 1) IF x[i].role = 'assistant']), 0) AS a FROM v
), b AS (
  SELECT w.conv_id, w.x AS c, coalesce(o.x, []) AS y, w.a, coalesce(o.a, 0) AS oa,
         o.conv_id IS NOT NULL AND w.x[1] <> o.x[1] AND w.a > 0 AND o.a > 0 AS swapped
  FROM w LEFT JOIN w AS o ON o.conv_id = xor(w.conv_id, 1)
), g AS (
  SELECT conv_id, swapped, c, CASE WHEN swapped THEN list_concat(c[1:a - 1], [y[oa]]) ELSE y END AS r FROM b
), l AS (
  SELECT *, coalesce(list_min([i FOR i IN range(1, least(len(c), len(r)) + 1) IF c[i] <> r[i]]) - 1, least(len(c), len(r))) AS n FROM g
), p AS (
  SELECT conv_id, swapped, len(c) > 0 AND len(r) > 0 AS paired, CAST(n AS BIGINT) AS n_prompt_turns,
         [x FOR x IN c[1:n]] AS pt, c[n + 1:] AS ct, r[n + 1:] AS rt FROM l
), s AS (
  SELECT *, ['<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10) FOR x IN pt] AS ps,
         ['<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10) FOR x IN ct] AS cs,
         ['<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10) FOR x IN rt] AS rs FROM p
)
SELECT conv_id, swapped, paired, n_prompt_turns, coalesce(array_to_string(ps, ''), '') AS prompt,
       coalesce(array_to_string(cs, ''), '') AS chosen, coalesce(array_to_string(rs, ''), '') AS rejected,
       coalesce(array_to_string([CAST(len(array_to_string(cs[1:i - 1], '')) + 13 + len(ct[i].role) AS VARCHAR) || ':' || CAST(len(array_to_string(cs[1:i], '')) - 1 AS VARCHAR) FOR i IN range(1, len(ct) + 1) IF ct[i].role = 'assistant'], ','), '') AS chosen_mask,
       coalesce(array_to_string([CAST(len(array_to_string(rs[1:i - 1], '')) + 13 + len(rt[i].role) AS VARCHAR) || ':' || CAST(len(array_to_string(rs[1:i], '')) - 1 AS VARCHAR) FOR i IN range(1, len(rt) + 1) IF rt[i].role = 'assistant'], ','), '') AS rejected_mask
FROM s
"""
