"""N-gram Jaccard join: size-aware, heavy and light, exact.

Two documents link when the Jaccard similarity of their sets of word shingles is
``THRESHOLD`` per cent or more. The join runs in four steps.

1. Frequencies. Documents are dealt into blocks. A block asks, for each of its shingles,
   in how many documents of all it stands: one packed array goes from each block to each
   bucket of shingles, one byte a shingle comes back. No shingle is ever a row.
2. Prefixes. By rising frequency, then hash, two sets that link share a shingle among
   the first n - ceil(t n) + 1 of each. A document with that many shingles of its
   own links with nothing, and needs no further step; passages that many documents
   share come last, and long lists arise only where texts are nearly alike.
3. Candidates. Small sets among themselves must share two of one shingle more, so each
   lists the pairs of its prefix (subsets of fixed size); pairs with a large set come from
   the inverted lists of single shingles. The size that divides them is the one for
   which pairs listed plus list entries scanned are fewest, from exact counts by size. Lists of the same
   entries are one list, so near copies cost a row or two each, not one for each shingle.
4. Verification. First each document is compared with one leader of its lists, and
   what links is one component. Only lists that still hold several components are
   looked at again, by leaders of each round, then by the pairs across components whose counts allow a link. So a
   group of near copies costs its size, not its square, and no link between components is lost.

Documents with equal sets are one class from step 1 on; a class counts once in every list.
Frequencies above 255 count as 255: any order that all sets share gives the same links.

Defined results: a null or blank text has an empty set and links with nothing; fewer than
five words are one shingle; rows that repeat an id belong together; a null id keeps a
null component; an empty table gives none. Texts are taken whole, at any length; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank, deal, discard, materialize, partitions_for, release, relieve
from .graph import components
from .shingles import mix, shingle_sets

THRESHOLD = 75
#: MB of input, as estimated by the optimiser, in a block.
BLOCK_MB = 6
LEAST_BLOCKS = 64
#: Rounds of leaders before all pairs across components are compared.
ROUNDS = 3
_CAP = 255


def _need(n):
    """The fewest shingles that a set of ``n`` shares with one that links to it."""
    return -(-THRESHOLD * n // 100)


def _sets(table: pa.Table) -> tuple[list[np.ndarray], list]:
    """Sets and ids of a block's documents."""
    sets, raws, held = [], [], 0
    for text in table.column("text").to_pylist():
        raws.append(text.encode())
        held += len(raws[-1])
        if held > 1 << 20:
            sets += shingle_sets(raws)
            raws, held = [], 0
    sets += shingle_sets(raws)
    return sets, table.column("doc_id").to_pylist()


def _split(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits more of each shingle, in one integer."""
    return hashes % np.uint64(buckets) << np.uint64(32) | hashes >> np.uint64(32)


def _ask(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        release("jaccard")
        sets, _ = _sets(table)
        keys = np.sort(_split(np.concatenate(sets) if sets else np.zeros(0, np.uint64), buckets))
        cuts = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)).tolist()
        low = keys.astype(np.uint32)
        found = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
        block = table.column("block")[0].as_py()
        return pa.table({"block": pa.array([block] * len(found), pa.int32()), "bucket": pa.array(found, pa.int32()), "keys": pa.array([low[cuts[k] : cuts[k + 1]].tobytes() for k in found], pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    asked = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("keys").combine_chunks()]
    every = np.sort(np.concatenate(asked))
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    keys = every[first]
    counts = np.minimum(np.diff(np.concatenate([first, [len(every)]])), _CAP).astype(np.uint8)
    out = []
    for one in asked:
        own = one[np.concatenate([[True], one[1:] != one[:-1]])]
        out.append(counts[np.searchsorted(keys, own)].tobytes())
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": pa.array(out, pa.binary())})


_DIGEST = "doc_id long, n int, f1 long, f2 long, own boolean, shared array<long>, prefix array<long>, first int"


def _prefixes(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        release("jaccard")
        sets, ids = _sets(docs)
        keys = [_split(s, buckets) for s in sets]
        every = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
        fresh = np.ones(len(every), bool)
        fresh[1:] = every[1:] != every[:-1]
        every = every[fresh]
        order = np.argsort(answers.column("bucket").to_numpy())
        blobs = answers.column("counts").to_pylist()
        counts = np.frombuffer(b"".join(blobs[k] for k in order), np.uint8)
        rows: dict[str, list] = {k: [] for k in ("doc_id", "n", "f1", "f2", "own", "shared", "prefix", "first")}
        seen: dict[tuple, int] = {}
        by_id = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
        with np.errstate(over="ignore"):
            for k in by_id:
                s = sets[k]
                n = len(s)
                f1, f2 = (int(mix(s + np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) if n else 0 for salt in (1, 2))
                shared = prefix = None
                first = 0
                if n > 2 and ids[k] is not None and (f1, f2, n) not in seen:
                    seen[f1, f2, n] = k
                    df = counts[np.searchsorted(every, keys[k])]
                    length = n - _need(n) + 1
                    alone = int((df == 1).sum())
                    if alone < length:
                        many = df > 1
                        inner, held = df[many], s[many]
                        rare = np.lexsort((held, inner))[: length + 1 - alone]
                        shared, prefix, first = held.view(np.int64), held[rare].view(np.int64), min(length - alone, len(rare))
                for name, value in zip(rows, (ids[k], n, f1, f2, shared is not None, shared, prefix, first), strict=True):
                    rows[name].append(value)
        kinds = {"doc_id": pa.int64(), "n": pa.int32(), "f1": pa.int64(), "f2": pa.int64(), "own": pa.bool_(), "shared": pa.list_(pa.int64()), "prefix": pa.list_(pa.int64()), "first": pa.int32()}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in rows.items()})

    return run


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For every row its id, set size and fingerprints; for the first of each set in a block that may link,
    its shared shingles and its prefix, of which ``first`` belong to the prefix for single shingles."""
    blocks = partitions_for(docs, BLOCK_MB, least=LEAST_BLOCKS)
    dealt = deal(docs.select(F.col(doc_id).cast("long").alias("doc_id"), blank(text).alias("text")), blocks)
    asked = dealt.groupBy("block").applyInArrow(_ask(blocks), "block int, bucket int, keys binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer, "block int, bucket int, counts binary")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_prefixes(blocks), _DIGEST)


def _boundary(entries: DataFrame, sets: DataFrame) -> int:
    """The size up to which sets are small: fewest pairs listed plus list entries scanned.

    A list is scanned only if it holds a large set, and each of its entries once, as leaders
    do; a small set lists the pairs of its prefix. Of equal costs the largest size wins, as
    pairs lead to fewer false candidates. The driver gets a row for each differing size of sets.
    """
    lists = entries.where("pos < first").groupBy("h").agg(F.count("*").alias("m"), F.max("n").alias("n"))
    scanned = lists.where("m > 1").groupBy("n").agg(F.sum("m").alias("scanned"))
    length = F.size("prefix").cast("long")
    listed = sets.groupBy("n").agg(F.sum(length * (length - 1) / 2).cast("long").alias("listed"))
    rows = {r.n: (r.scanned or 0, r.listed or 0) for r in scanned.join(listed, "n", "full_outer").collect()}
    best, cost, at = 0, 0, 0
    for n in sorted(rows):
        cost += rows[n][1] - rows[n][0]
        if cost <= best:
            best, at = cost, n
    return at


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) that link."""
    left = sets.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("s_a"))
    right = sets.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    fits = (100 * F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b")) & (100 * both >= THRESHOLD * (F.col("n_a") + F.col("n_b") - both))
    return pairs.join(left, "a").join(right, "b").where(fits).select("a", "b")


def _lists(entries: DataFrame, sets: DataFrame, small: int) -> DataFrame:
    """(h, doc, n, large): single shingles for pairs with a large set, pairs of shingles for small sets."""
    large = F.col("n") > small
    single = entries.where("pos < first").select("h", "doc", "n", large.alias("large"))
    if not small:
        return single
    single = single.join(single.where("large").select("h").distinct(), "h", "left_semi")
    first = sets.where(~large).select("doc", "n", "prefix", F.posexplode("prefix").alias("pos", "h1"))
    both = first.select("doc", "n", "h1", F.explode(F.slice("prefix", F.col("pos") + 2, F.size("prefix"))).alias("h2"))
    return single.unionByName(both.select(F.xxhash64(F.least("h1", "h2"), F.greatest("h1", "h2")).alias("h"), "doc", "n", F.lit(True).alias("large")))


def _differing(lists: DataFrame) -> DataFrame:
    """One list of those that hold the same entries, and none of a single entry.

    Texts that are nearly alike share most of a prefix, and so as many equal lists; entries
    are compared by sums of four hashes of 28 bits, which no list can overflow.
    """
    marks = []
    for salt in (1, 2):
        mark = F.xxhash64("doc", "n", "large", F.lit(salt))
        marks += [F.sum(F.shiftrightunsigned(mark, 36)), F.sum(mark.bitwiseAND(F.lit((1 << 28) - 1)))]
    sums = [x.alias(f"s{k}") for k, x in enumerate(marks)]
    sizes = lists.groupBy("h").agg(F.count("*").alias("m"), *sums).where("m > 1")
    kept = sizes.groupBy("m", "s0", "s1", "s2", "s3").agg(F.min("h").alias("h")).select("h")
    return lists.join(kept, "h", "left_semi")


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    every = materialize(digests(docs, text, doc_id), "jaccard-digests")
    spark = docs.sparkSession
    classes = materialize(every.where("n > 0 and doc_id is not null").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("doc")), "jaccard-classes")
    kept = every.where("own").join(classes, ["f1", "f2", "n"]).where(F.col("doc_id") == F.col("doc"))
    sets = materialize(kept.select("doc", "n", "shared", "prefix", "first").dropDuplicates(["doc", "n", "prefix"]), "jaccard-sets")
    entries = sets.select("doc", "n", "first", F.posexplode("prefix").alias("pos", "h"))
    lists = materialize(_differing(_lists(entries, sets, _boundary(entries, sets))), "jaccard-lists")

    # A node is a document; ids that repeat with other texts hold their sets together.
    labels = sets.select(F.col("doc").alias("node"), F.col("doc").alias("component")).distinct()
    links = spark.createDataFrame([], "a long, b long")
    done = spark.createDataFrame([], "a long, b long")
    active = held = lists
    for turn in range(ROUNDS + 1):
        relieve(spark, collect=True)
        marked = active.drop("component").join(labels, F.col("doc") == F.col("node")).drop("node")
        if turn:  # at first every document is its own component, and every list open
            held = marked = materialize(marked, "jaccard-marked")
            open_ = marked.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("h")
            marked = marked.join(open_, "h", "left_semi")
        last, active = active, materialize(marked, "jaccard-open")
        discard(held)
        if last is not held:
            discard(last)
        if active.isEmpty():
            break
        pairs = _leaders(active, turn) if turn < ROUNDS else _across(active, sets)
        pairs = materialize(pairs.distinct().join(done, ["a", "b"], "left_anti"), "jaccard-pairs")
        found = materialize(_verified(pairs, sets), "jaccard-links")
        done, links = done.unionByName(pairs), links.unionByName(found)
        if turn < ROUNDS:
            if found.isEmpty():
                continue
            grown = components(links)
            labels = labels.select("node").join(grown, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
            labels = materialize(labels, "jaccard-labels")
    final = components(links)
    member = every.select("doc_id", "n", "f1", "f2").join(classes, ["f1", "f2", "n"], "left")
    tied = member.where("doc_id is not null and doc is not null and doc_id <> doc").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    repeated = member.where("doc is not null").select("doc_id", "doc").distinct().groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
    if not repeated.isEmpty():  # an id with several texts ties their classes
        final = components(links.unionByName(tied))
        return member.join(final, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return member.join(final, F.col("doc") == F.col("node"), "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id")).alias("component_id"))


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _leaders(active: DataFrame, turn: int) -> DataFrame:
    """For each document one pair with a leader, of another component, from its lists.

    The first round takes the lowest id of a list, later ones the lowest of hashes that change.
    """
    rank = F.col("doc") if turn == 0 else F.xxhash64("doc", F.lit(turn))
    lead = active.where("large").groupBy("h").agg(F.min(F.struct(rank.alias("r"), F.col("doc").alias("leader"), F.col("component").alias("other"))).alias("l")).select("h", "l.leader", "l.other", F.col("l.r").alias("r"))
    met = active.join(lead, "h").where("component <> other")
    best = met.groupBy("doc").agg(F.min(F.struct("r", "leader")).alias("l"))
    return best.select(*_ordered(F.col("doc"), F.col("l.leader")))


def _crossing(active: DataFrame, sets: DataFrame) -> DataFrame:
    """(doc, n, crossing): the shingles of an active set that stand in one of another component.

    No others can be shared across components. Sets with fewer than any partner needs are left out.
    """
    nodes = active.select("doc", "component").distinct()
    each = sets.join(nodes, "doc").select("doc", "n", "component", F.explode("shared").alias("s"))
    both = each.groupBy("s").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q").select("s")
    held = each.join(both, "s").groupBy("doc", "n").agg(F.collect_set("s").alias("crossing"))
    return held.where(100 * F.size("crossing") >= THRESHOLD * F.col("n"))


#: Documents from which a list has a pivot: shorter ones have few pairs.
LONG = 32
#: How much longer than the one before a band of set sizes is.
_BAND = 1.02


def _band(n: Column) -> Column:
    return F.floor(F.log(n) / float(np.log(_BAND))).cast("int")


def _across(active: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of a list, with a large set in it, whose components differ and that may link.

    In a list every such pair has a side outside the list's largest component. Those sides
    seek; a seeker with x shingles to share links only with sets of size
    x (1 + 1 / t) - n or less, and meets only the bands of sizes up to there. The first
    document of the largest component is the pivot of a long list: what two sets share inside it is at
    most the lesser share with it, and outside it the lesser rest. Long lists of one
    largest component are one list, so a pair is met once.
    """
    nodes = materialize(_crossing(active, sets), "jaccard-crossing")
    sizes = active.groupBy("h", "component").agg(F.count("*").alias("m"))
    main = sizes.groupBy("h").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.sum("m").alias("m"))
    long = F.col("m") >= LONG
    listed = active.join(main, "h").groupBy(long.alias("long"), F.when(long, F.col("main")).otherwise(F.col("h")).alias("h"), "main", "doc", "n", "component").agg(F.max("large").alias("large"))
    pivots = sets.groupBy(F.col("doc").alias("main")).agg(F.max_by("shared", "n").alias("pivot"))
    shares = listed.where("long").select("doc", "n", "main").distinct().join(nodes, ["doc", "n"]).join(pivots, "main")
    inside = F.size(F.array_intersect("crossing", "pivot"))
    shares = materialize(shares.select("doc", "n", "main", inside.alias("i")), "jaccard-pivots")
    all_ = listed.join(nodes.select("doc", "n", F.size("crossing").alias("x")), ["doc", "n"]).join(shares, ["doc", "n", "main"], "left").withColumn("i", F.when(F.col("long"), F.coalesce("i", F.lit(0))).otherwise(F.lit(0)))
    most = F.floor((100 + THRESHOLD) * F.col("x") / THRESHOLD).cast("int") - F.col("n")
    low, high = F.ceil(THRESHOLD * F.col("n") / 100), F.least(F.floor(100 * F.col("n") / THRESHOLD), most)
    seekers = all_.where("component <> main").withColumns({"low": low, "high": high}).where("high >= low and low > 0")
    seekers = seekers.select("long", "h", F.col("doc").alias("d"), F.col("n").alias("n_d"), F.col("x").alias("x_d"), F.col("i").alias("i_d"), F.col("component").alias("c_d"), F.col("large").alias("l_d"), F.explode(F.sequence(_band(F.col("low")), _band(F.col("high")))).alias("band"))
    held = all_.select("long", "h", "doc", "n", "x", "i", "component", "large", (F.col("component") == F.col("main")).alias("settled"), _band(F.col("n")).alias("band"))
    shared = F.least("i", "i_d") + F.least(F.col("x") - F.col("i"), F.col("x_d") - F.col("i_d"))
    fits = (100 + THRESHOLD) * shared >= THRESHOLD * (F.col("n") + F.col("n_d"))
    near = (100 * F.least("n", "n_d") >= THRESHOLD * F.greatest("n", "n_d")) & (F.col("component") != F.col("c_d")) & (F.col("large") | F.col("l_d")) & (F.col("settled") | (F.col("doc") < F.col("d"))) & fits
    return seekers.join(held, ["long", "h", "band"]).where(near).select(*_ordered(F.col("doc"), F.col("d")))


#: The join in SQL that DuckDB runs: every pair that shares a shingle is counted, and links are followed to the end.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w
), e AS (
  SELECT doc_id, unnest(s) AS h, len(s) AS n FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), l AS (
  SELECT a, b FROM p UNION ALL SELECT b, a FROM p
), r AS (
  SELECT a AS doc_id, a AS c FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id
), m AS (
  SELECT doc_id, min(c) AS c FROM r GROUP BY 1
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(m.c, s.doc_id) AS component_id FROM s LEFT JOIN m ON m.doc_id = s.doc_id
"""
