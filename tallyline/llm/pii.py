"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Base spans (email, ip, card, phone) are found by pattern and checked natively, and so are
secrets (keys and tokens). Their values are the protected entities. A term is a word of three letters or more that
stands within ``WINDOW`` characters of an entity. Over the corpus, with N differing texts,
n(e) of them having entity e, n(t) having term t anywhere, and n(t, e) having both
in one window, t reveals of e the share

    PMI(t, e) / IC(e) = log(n(t, e) N / (n(t) n(e))) / log(N / n(e))

of its information: 1 where t never stands without e. All four count differing texts,
so exact copies count once on either side of the share. Terms that stand with e in
``SUPPORT`` differing windows or more are generalised to a label from the share
``GENERALISE`` on and removed from ``REMOVE`` on, in the windows of the entity they reveal.

n(t) is counted over every differing text, for the terms that have the support; the entities
and terms are aggregated before each shuffle, so one entity in a third of all rows
adds a partial row for each task.

Defined results: a null or empty text has no span; rows that repeat get the same spans
each; no table column but ``doc_id`` and the text is used, others are kept by
``sanitise``; an empty table gives an empty one. Texts of any length are taken whole;
offsets count code points. Where N = n(e), e carries no information and reveals nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank, materialize, positions

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns. Guards and possessive loops keep each scan linear and free of recursion;
#: they find what the plain forms find, as a match that starts inside a run of its first
#: class could have started where the run, or what an earlier match left of it, does.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Beside the base kinds: a key or token, which is a run of 32 or more hexadecimal digits with a digit and a
#: letter among them, or of 24 or more letters and digits with a digit and letters of both cases.
SECRET = "secret"
PATTERNS[SECRET] = r"(?<![0-9A-Za-z])(?:(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{32,}+|(?=[A-Za-z]*+[0-9])(?=[0-9A-Z]*+[a-z])(?=[0-9a-z]*+[A-Z])[0-9A-Za-z]{24,}+)(?![0-9A-Za-z])"
ENTITIES = (*KINDS, SECRET)
#: What a text must contain for a pattern to be tried.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
TERM = r"(?<![\p{L}\p{M}])\p{L}[\p{L}\p{M}]{2,}+"
WINDOW = 120
SUPPORT, GENERALISE, REMOVE = 2, 0.8, 0.95
#: Bytes in memory, from their exact lengths, up to which the candidate terms are broadcast; beyond, tokens are counted first and joined.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64

_LOCATED = "array<struct<start:int,stop:int,hit:string>>"
_SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"


def _located(text: Column, pattern: str, hits: Column) -> Column:
    """Where the matches ``hits`` of ``pattern`` stand: the gaps between them are what splitting leaves."""
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(F.char_length(gap).alias("gap"), hit.alias("hit")))

    def place(at, x):
        start = at + x["gap"]
        return F.struct(start.alias("start"), (start + F.char_length(x["hit"])).alias("stop"), x["hit"].alias("hit"))

    got = positions(pairs, lambda x: x["gap"] + F.char_length(x["hit"]), place, "struct<start:int,stop:int,hit:string>")
    return F.when(F.size(hits) > 0, got).otherwise(F.array().cast(_LOCATED))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    digits = F.split(F.reverse(_digits(hit)), "")
    each = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        def low(part):
            short = F.ltrim(part, F.lit("0"))
            return (F.length(short) <= 3) & (F.coalesce(F.try_to_number(short, F.lit("999")), F.lit(0)) <= 255)

        return F.forall(F.split(hit, r"\."), low)
    if kind == "card":
        n = F.length(_digits(hit))
        return F.when((n >= 14) & (n <= 19), _luhn(hit)).otherwise(False)
    if kind == "phone":
        n = F.length(_digits(hit))
        return (n >= 10) & (n <= 15)
    return F.lit(True)


def _checked(located: Column, kind: str) -> Column:
    return F.filter(located, lambda s: _valid(kind, s["hit"]))


def _entity(kind: str, hit: Column) -> Column:
    """The value that is protected: spelling aside."""
    return F.concat(F.lit(f"{kind} "), F.lower(hit) if kind in ("email", "ip", SECRET) else _digits(hit))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__text`` (null: empty) and, by kind, the valid matches ``__email`` and so on."""
    out = docs.withColumn("__text", blank(text))
    hits = {k: F.regexp_extract_all("__text", F.lit(PATTERNS[k]), F.lit(0)) for k in ENTITIES}
    none = F.array().cast("array<string>")
    out = out.withColumns({f"__{k}_hits": F.when(F.contains("__text", F.lit(HINTS[k])), h).otherwise(none) if k in HINTS else h for k, h in hits.items()})
    located = {f"__{k}": _checked(_located(F.col("__text"), PATTERNS[k], F.col(f"__{k}_hits")), k) for k in ENTITIES}
    return out.withColumns(located).drop(*(f"__{k}_hits" for k in ENTITIES))


def _ranked(*kinds: str) -> Column:
    """The spans of the kinds, by start."""

    def ranked(kind: str) -> Column:
        rank = F.lit(ENTITIES.index(kind))
        return F.transform(f"__{kind}", lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))

    return F.array_sort(F.concat(*map(ranked, kinds)).cast(_SPAN))


def _windows() -> Column:
    """For every base span: its entity, and where its window starts and ends."""

    def around(kind: str) -> Column:
        return F.transform(f"__{kind}", lambda s: F.struct(_entity(kind, s["hit"]).alias("entity"), F.greatest(s["start"] - WINDOW, F.lit(0)).alias("a"), s["start"].alias("start"), s["stop"].alias("stop")))

    return F.concat(*map(around, ENTITIES))


def contexts(found: DataFrame, key: list[str]) -> DataFrame:
    """A row for each entity, window and term in it: key, entity, window (a hash), term, start, stop."""
    rows = found.select(*key, "__text", F.explode(_windows()).alias("w")).select(*key, "w.*", F.char_length("__text").alias("n"), F.expr(f"substring(__text, w.a + 1, w.stop - w.a + {WINDOW})").alias("around"))
    rows = rows.withColumn("window", F.xxhash64(F.lower("around")))
    rows = rows.withColumn("hits", F.regexp_extract_all("around", F.lit(TERM), F.lit(0))).withColumn("terms", _located(F.col("around"), TERM, F.col("hits")))
    rows = rows.select(*key, "entity", "window", "a", "n", F.col("start").alias("from"), F.col("stop").alias("to"), F.char_length("around").alias("wide"), F.explode("terms").alias("t"))
    whole = ((F.col("t.start") > 0) | (F.col("a") == 0)) & ((F.col("t.stop") < F.col("wide")) | (F.col("a") + F.col("wide") == F.col("n")))
    start, stop = F.col("a") + F.col("t.start"), F.col("a") + F.col("t.stop")
    apart = (stop <= F.col("from")) | (start >= F.col("to"))
    return rows.where(whole & apart).select(*key, "entity", "window", F.lower("t.hit").alias("term"), start.alias("start"), stop.alias("stop"))


def disclosure(docs: DataFrame, near: DataFrame, text: str = "text") -> DataFrame:
    """(entity, term, share) for pairs with the support, from ``contexts`` by ``text_key`` and the whole corpus."""
    windows = near.select("entity", "window", "term").distinct()
    supported = windows.groupBy("entity", "term").agg(F.count("*").alias("n_windows")).where(F.col("n_windows") >= SUPPORT)
    both = near.select("entity", "text_key", "term").distinct().groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    entities = near.select("entity", "text_key").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = materialize(supported.join(both, ["entity", "term"]).join(entities, "entity"), "pii-pairs")
    terms = materialize(pairs.select("term").distinct(), "pii-terms")
    keyed = docs.select(blank(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    tokens = keyed.dropDuplicates(["text_key"]).select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    size = terms.agg(F.sum(F.octet_length("term") + ROW_BYTES)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        tokens = tokens.join(F.broadcast(terms), "term", "left_semi")
    counts = tokens.groupBy("term").agg(F.count("*").alias("n_term"))
    total = keyed.select("text_key").distinct().count()
    joined = pairs.join(counts, "term")
    information = F.log(F.lit(float(max(total, 1))) / F.col("n_entity"))
    share = F.log(F.least("n_both", "n_term").cast("double") * F.lit(float(max(total, 1))) / (F.col("n_term").cast("double") * F.col("n_entity"))) / information
    return joined.where(information > 0).select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For each row: doc_id, ``text_key`` (a hash of its text), the number of each kind, ``base`` and ``terms``, both arrays of spans.

    ``terms`` has secrets, and the terms that reveal an entity, of kind ``term`` (generalised) or ``drop``
    (removed), which lie outside the other spans.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = find(chosen).withColumn("text_key", F.xxhash64("__text"))
    key = ["doc_id", "text_key"]
    numbers = [F.size(f"__{k}") for k in ENTITIES]
    slim = found.select(
        *key, _ranked(*KINDS).alias("base"), _ranked(SECRET).alias("secrets"), *(n.cast("long").alias(f"n_{k}") for k, n in zip(ENTITIES, numbers, strict=True)),
        F.when(sum(numbers, F.lit(0)) > 0, F.col("__text")).alias("__text"), *(f"__{k}" for k in ENTITIES),
    )
    slim = materialize(slim, "pii-base")
    near = materialize(contexts(slim.where(F.col("__text").isNotNull()), key), "pii-near")
    told = materialize(disclosure(chosen, near), "pii-told")
    kind = F.when(F.max("share") >= REMOVE, F.lit("drop")).otherwise(F.lit("term"))
    marked = near.join(told, ["entity", "term"]).groupBy(*key, "start", "stop").agg(kind.alias("kind"))
    marked = marked.groupBy(*key).agg(F.collect_list(F.struct("start", F.lit(len(ENTITIES)).alias("rank"), "stop", "kind")).cast(_SPAN).alias("marked"))
    marked = marked.withColumnsRenamed({k: f"m_{k}" for k in key})
    both = slim.drop("__text", *(f"__{k}" for k in ENTITIES)).join(marked, F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & (F.col("text_key") == F.col("m_text_key")), "left")
    clear = F.filter(F.coalesce("marked", F.array().cast(_SPAN)), lambda t: ~F.exists(F.concat("base", "secrets"), lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    return both.select(*key, *(f"n_{k}" for k in ENTITIES), "base", F.array_sort(F.concat("secrets", clear)).alias("terms"))


def joined(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def sanitise(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with spans replaced in the text: base ones and terms by a label, dropped terms by nothing.

    The columns and rows stay as they are; a null text stays null.
    """
    found = spans(docs, text, doc_id).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.concat("base", "terms").alias("__all")).where(F.size("__all") > 0).distinct()
    keyed = docs.withColumn("__own", F.xxhash64(blank(text)))
    both = keyed.join(found, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")
    source = F.col(text)

    def step(acc, s):
        gap = F.when(s["start"] > acc["at"], F.substring(source, acc["at"] + 1, s["start"] - acc["at"])).otherwise(F.lit(""))
        label = F.when((s["kind"] == "drop") | (s["start"] < acc["at"]), F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.concat(acc["out"], F.array(gap, label)).alias("out"))

    done = F.aggregate(F.array_sort("__all"), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(source, acc["at"] + 1, F.char_length(source))))
    return both.withColumn(text, F.when(F.col("__all").isNull(), source).otherwise(done)).select(*docs.columns)
