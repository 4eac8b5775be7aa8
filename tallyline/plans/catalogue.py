"""The registered queries over the driver's tables, and the SQL each must agree with.

lineitem stands for raw records (key l_orderkey, sequence l_linenumber), orders for the
ledger, events for an ordered stream by user, conversations for records without gaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import dedup, ledger, projection, stats, validate
from tallyline.plans import planning

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CHUNK = 1000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(column: str):
    """Epoch milliseconds of a time without zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({column} AS TIMESTAMP_NTZ))")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as (instrument_name, trade_seq, timestamp)."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("instrument_name"), F.col("l_linenumber").cast("long").alias("trade_seq"), millis("l_shipdate").alias("timestamp"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a bound; lines without one stay in the verdicts by the full join."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("instrument_name"), (F.col("o_orderkey") % 4).alias("max_seq"), (F.col("o_orderstatus") == "F").alias("is_complete"))


def future_ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ledger tables made of orders, and of one chunk for each of their lines."""
    meta = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("instrument"), (F.col("o_orderstatus") != "O").cast("int").alias("is_expired"), (F.col("o_orderstatus") == "P").cast("int").alias("is_completed"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("instrument"), F.col("l_linenumber").cast("long").alias("chunk_no"))
    chunks = lines.agg(F.count("*").alias("count"), (F.max("l_partkey") % 2).cast("int").alias("has_more"), (F.max("l_suppkey") % 2).cast("int").alias("is_done"))
    return meta, chunks


META_SQL = "SELECT CAST(o_orderkey AS VARCHAR) AS instrument, CAST(o_orderstatus <> 'O' AS INT) AS is_expired, CAST(o_orderstatus = 'P' AS INT) AS is_completed FROM orders"
CHUNK_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS instrument, CAST(l_linenumber AS BIGINT) AS chunk_no, count(*) AS "count",
  CAST(max(l_partkey) % 2 AS INT) AS has_more, CAST(max(l_suppkey) % 2 AS INT) AS is_done FROM lineitem GROUP BY 1, 2"""
LEDGER_SQL = f"WITH m AS ({META_SQL}), c AS ({CHUNK_SQL})"
PAYLOAD = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
COLUMNS = ", ".join(("l_orderkey", "l_linenumber", *PAYLOAD))


# ----------------------------------------------------------------- projection and deduplication


@query(
    """SELECT CAST(l_linenumber AS BIGINT) AS trade_seq, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trade_id, epoch_ms(l_shipdate) AS "timestamp",
  CAST(NULL AS BIGINT) AS tick_direction, l_extendedprice AS price, CAST(NULL AS DOUBLE) AS mark_price, CAST(NULL AS DOUBLE) AS iv, CAST(l_orderkey AS VARCHAR) AS instrument_name,
  CAST(NULL AS DOUBLE) AS index_price, CASE WHEN l_linestatus = 'O' THEN 'buy' ELSE 'sell' END AS direction, l_quantity AS amount, CAST(NULL AS DOUBLE) AS contracts,
  CAST(NULL AS VARCHAR) AS block_trade_id, CAST(NULL AS VARCHAR) AS block_rfq_id, CAST(NULL AS BIGINT) AS block_trade_leg_count, CAST(NULL AS VARCHAR) AS combo_id,
  CAST(NULL AS VARCHAR) AS combo_trade_id, CAST(NULL AS VARCHAR) AS liquidation FROM lineitem"""
)
def canonical_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.canonical(
        table(spark, sf_dir, "lineitem"),
        {
            "trade_seq": "l_linenumber", "trade_id": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")), "timestamp": millis("l_shipdate"),
            "price": "l_extendedprice", "instrument_name": "l_orderkey", "direction": F.when(F.col("l_linestatus") == "O", "buy").otherwise("sell"), "amount": "l_quantity",
        },
    )


@query(f"SELECT {COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(PAYLOAD)}) AS k FROM lineitem) WHERE k = 1")
def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_wins(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *PAYLOAD), PAYLOAD, "l_orderkey", "l_linenumber").withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


@query("SELECT l_orderkey, count(*) AS rows_in, count(DISTINCT l_linenumber) AS rows_out, count(*) - count(DISTINCT l_linenumber) AS removed FROM lineitem GROUP BY 1")
def dedup_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.accounting(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_unique FROM lineitem GROUP BY 1")
def dedup_bitmap_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bitmap_count(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber > 4")
def dedup_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.above(table(spark, sf_dir, "lineitem"), 4, "l_linenumber").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey % 2 = 1 AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_partkey % 2 = 0)")
def dedup_cross_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file is rows of even parts; the other keeps what the first has not seen, by order number."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return projection.unseen(rows.where("l_partkey % 2 = 1"), rows.where("l_partkey % 2 = 0"), "l_orderkey")


@query(
    """WITH f AS (SELECT l_orderkey, l_linenumber, min(l_suppkey % 4) AS b FROM lineitem GROUP BY 1, 2), o AS (SELECT b, count(*) AS n FROM f GROUP BY 1),
  i AS (SELECT l_suppkey % 4 AS b, count(*) AS n FROM lineitem GROUP BY 1)
SELECT i.b AS batch, i.n AS rows_in, coalesce(o.n, 0) AS rows_out, i.n - coalesce(o.n, 0) AS removed FROM i LEFT JOIN o ON i.b = o.b"""
)
def dedup_cross_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 4).alias("batch"))
    return dedup.batches(rows, "batch", "l_orderkey", "l_linenumber")


@query(
    f"""WITH f AS (SELECT *, 'file-' || CAST(l_suppkey % 7 AS VARCHAR) AS name FROM lineitem), s AS (SELECT name, count(*) AS size FROM f GROUP BY 1),
  r AS (SELECT f.*, size, size < (SELECT count(*) / 7.0 FROM lineitem) AS small FROM f JOIN s ON f.name = s.name)
SELECT l_orderkey, l_linenumber, name, small, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY small, name, {', '.join(PAYLOAD)}) AS k FROM r) WHERE k = 1"""
)
def dedup_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each key the row of the large files first, then of the first name, then of the first position; a file is the lines of suppliers."""
    rows = table(spark, sf_dir, "lineitem").withColumn("name", F.concat(F.lit("file-"), (F.col("l_suppkey") % 7).cast("string")))
    sizes = rows.groupBy("name").agg(F.count("*").alias("size"))
    limit = sizes.agg((F.sum("size") / 7).alias("limit"))
    sizes = sizes.join(F.broadcast(limit)).select("name", (F.col("size") < F.col("limit")).alias("small"))
    ranked = rows.join(F.broadcast(sizes), "name")
    return dedup.first_wins(ranked, ("small", "name", *PAYLOAD), "l_orderkey", "l_linenumber").select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "name", "small", "l_partkey")


@query("SELECT l_orderkey AS instrument_name, CAST(l_linenumber AS BIGINT) AS trade_seq, epoch_ms(l_shipdate) AS \"timestamp\" FROM lineitem")
def dedup_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir)


# ----------------------------------------------------------------- statistics and verdicts

STATS_SQL = """SELECT l_orderkey AS instrument_name, count(*) AS n_rows, count(DISTINCT l_linenumber) AS n_unique, CAST(min(l_linenumber) AS BIGINT) AS seq_min,
  CAST(max(l_linenumber) AS BIGINT) AS seq_max, epoch_ms(min(l_shipdate)) AS ts_min, epoch_ms(max(l_shipdate)) AS ts_max FROM lineitem GROUP BY 1"""


def detail_sql(stats_sql: str, targets_sql: str) -> str:
    return f"""WITH s AS ({stats_sql}), t AS ({targets_sql}), j AS (
  SELECT coalesce(s.instrument_name, t.instrument_name) AS instrument_name, coalesce(n_rows, 0) AS n_rows, coalesce(n_unique, 0) AS n_unique, seq_min, seq_max, max_seq, is_complete,
         coalesce(seq_max - seq_min + 1 - n_unique, 0) AS gaps FROM s FULL OUTER JOIN t ON s.instrument_name = t.instrument_name
), r AS (
  SELECT *, concat_ws('; ',
    CASE WHEN n_rows <> n_unique THEN CAST(n_rows - n_unique AS VARCHAR) || ' duplicates' END,
    CASE WHEN n_unique > 0 AND gaps > 0 THEN CAST(gaps AS VARCHAR) || ' internal gaps' END,
    CASE WHEN max_seq > 0 AND (seq_min IS NULL OR seq_min <> 1) THEN 'missing head' END,
    CASE WHEN max_seq > 0 AND (seq_max IS NULL OR seq_max < max_seq) THEN 'missing known tail through ' || CAST(max_seq AS VARCHAR) END,
    CASE WHEN max_seq > 0 AND is_complete AND seq_max > max_seq THEN 'rows beyond final checkpoint ' || CAST(max_seq AS VARCHAR) END,
    CASE WHEN max_seq = 0 AND n_rows > 0 THEN 'checkpoint expects no rows' END) AS why FROM j
)
SELECT instrument_name, n_rows, n_unique, seq_min, seq_max, max_seq, is_complete, gaps,
  CASE WHEN why <> '' THEN 'INCOMPLETE' WHEN is_complete THEN 'COMPLETE' ELSE 'UNKNOWN' END AS status,
  CASE WHEN why <> '' THEN why WHEN is_complete IS NULL THEN 'no checkpoint target' WHEN NOT is_complete THEN 'checkpoint upper bound is not final' ELSE 'checkpoint range matched' END AS reasons FROM r"""


TARGETS_SQL = "SELECT o_orderkey AS instrument_name, o_orderkey % 4 AS max_seq, o_orderstatus = 'F' AS is_complete FROM orders"
DETAIL_SQL = detail_sql(STATS_SQL, TARGETS_SQL)
SUMMARY_SQL = "SELECT count(*) FILTER (status = 'COMPLETE') AS complete, count(*) FILTER (status = 'INCOMPLETE') AS incomplete, count(*) FILTER (status = 'UNKNOWN') AS \"unknown\", CAST(sum(n_rows) AS BIGINT) AS n_rows"


@query(STATS_SQL)
def instrument_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_key(records(spark, sf_dir))


TALK_SQL = "SELECT conv_id AS instrument_name, count(*) AS n_rows, count(DISTINCT turn) AS n_unique, min(turn) + 1 AS seq_min, max(turn) + 1 AS seq_max FROM conversations GROUP BY 1"


@query(TALK_SQL)
def conversation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("instrument_name"), (F.col("turn") + 1).alias("trade_seq"))
    return stats.by_key(rows, time=None)


@query("SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_keys, strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day FROM events")
def time_range_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("instrument_name"), F.col("event_id").alias("trade_seq"), millis("ts").alias("timestamp"))
    return stats.totals(stats.by_key(rows))


@query(DETAIL_SQL)
def validate_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.detail(stats.by_key(records(spark, sf_dir)), targets(spark, sf_dir))


@query(detail_sql(STATS_SQL.replace("count(*) AS n_rows", "count(DISTINCT l_linenumber) AS n_rows"), TARGETS_SQL))
def validate_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts after exact deduplication."""
    return validate.detail(stats.by_key(dedup.first_wins(records(spark, sf_dir), ["timestamp"])), targets(spark, sf_dir))


@query(f"{SUMMARY_SQL} FROM ({DETAIL_SQL})")
def validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.summary(validate_detail(spark, sf_dir))


@query(f"SELECT CASE WHEN incomplete > 0 THEN 1 WHEN \"unknown\" > 0 THEN 2 ELSE 0 END AS exit_code FROM ({SUMMARY_SQL} FROM ({DETAIL_SQL}))")
def validate_exit_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.exit_code(validate_summary(spark, sf_dir))


@query(detail_sql(TALK_SQL, "SELECT conv_id AS instrument_name, max(turn) + 1 AS max_seq, true AS is_complete FROM conversations GROUP BY 1"))
def validate_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("instrument_name")).agg((F.max("turn") + 1).alias("max_seq"), F.lit(True).alias("is_complete"))
    return validate.detail(conversation_stats(spark, sf_dir), bounds)


HISTOGRAM_SQL = """WITH s AS (SELECT user_id, min(event_id) AS low, max(event_id) - min(event_id) + 1 AS total FROM events GROUP BY 1 HAVING max(event_id) - min(event_id) + 1 > count(DISTINCT event_id)),
  e AS (SELECT DISTINCT user_id, event_id FROM events), c AS (SELECT e.user_id, least(greatest((event_id - low) * 10 // total, 0), 9) AS bucket, count(*) AS found FROM e JOIN s ON e.user_id = s.user_id GROUP BY 1, 2),
  p AS (SELECT s.*, CAST(b AS INT) AS bucket FROM s, range(10) AS r(b))
SELECT p.user_id, p.bucket, coalesce(found, 0) AS found, {want} AS expected, {want} - coalesce(found, 0) AS missing FROM p LEFT JOIN c ON p.user_id = c.user_id AND p.bucket = c.bucket"""


def _histogram(spark: SparkSession, sf_dir: str, expected: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id")
    return validate.histogram(rows, None, expected, "user_id", "event_id")


@query(HISTOGRAM_SQL.format(want="(total // 10 + CAST(p.bucket < total % 10 AS BIGINT))"))
def gap_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _histogram(spark, sf_dir, "compat")


@query(HISTOGRAM_SQL.format(want="(((p.bucket + 1) * total + 9) // 10 - (p.bucket * total + 9) // 10)"))
def gap_histogram_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _histogram(spark, sf_dir, "exact")


# ----------------------------------------------------------------- planning

BOUNDS_SQL = "SELECT CAST(user_id AS VARCHAR) AS instrument, max(event_id) AS last_seq FROM events GROUP BY 1"


def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("instrument")).agg(F.max("event_id").alias("last_seq"))


@query(f"SELECT instrument, x AS chunk_no, least(x + {CHUNK - 1}, last_seq) AS end_seq FROM ({BOUNDS_SQL}), unnest(range(1, last_seq + 1, {CHUNK})) AS u(x) WHERE last_seq > 0")
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.chunk_plan(bounds(spark, sf_dir), CHUNK)


PENDING_SQL = f"SELECT DISTINCT CAST(user_id AS VARCHAR) AS instrument, event_id // {CHUNK} * {CHUNK} + 1 AS chunk_no FROM events WHERE event_id % 3 = 0"


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_id % 3 = 0")
    return rows.select(F.col("user_id").cast("string").alias("instrument"), F.expr(f"event_id div {CHUNK} * {CHUNK} + 1").alias("chunk_no")).distinct()


def _even(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("instrument").cast("long") % 2 == 0)


@query(f"SELECT p.instrument, chunk_no, least(chunk_no + {CHUNK - 1}, last_seq) AS end_seq FROM ({PENDING_SQL}) p JOIN ({BOUNDS_SQL}) b ON p.instrument = b.instrument WHERE last_seq > 0 AND chunk_no <= last_seq AND CAST(p.instrument AS BIGINT) % 2 = 0")
def bounded_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds are known of even users only."""
    return planning.bounded_pending(_pending(spark, sf_dir), _even(bounds(spark, sf_dir)), CHUNK)


@query(f"SELECT DISTINCT instrument FROM ({PENDING_SQL}) WHERE CAST(instrument AS BIGINT) % 2 <> 0")
def unbounded_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = bounds(spark, sf_dir).withColumn("last_seq", F.greatest("last_seq", F.lit(1)))
    return planning.unbounded(_pending(spark, sf_dir), _even(known))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS instrument, last_seq, CASE WHEN last_seq IS NULL THEN 'unknown' WHEN last_seq = 0 THEN 'empty' ELSE 'plan' END AS state
  FROM orders LEFT JOIN (SELECT l_orderkey, CAST(max(l_linenumber) - 1 AS BIGINT) AS last_seq FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""
)
def last_seq_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("instrument"))
    known = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("instrument")).agg((F.max("l_linenumber") - 1).cast("long").alias("last_seq"))
    return planning.triaged(listed, known)


@query(
    """SELECT CAST(user_id AS VARCHAR) AS instrument, event_id // 500 * 500 AS "start", event_id // 500 * 500 + 9 AS "end", count(*) AS received,
  count(DISTINCT CASE WHEN event_id % 500 < 10 THEN event_id END) AS covered, CAST(10 AS BIGINT) AS width, count(DISTINCT CASE WHEN event_id % 500 < 10 THEN event_id END) = 10 AS proved FROM events GROUP BY 1, 2"""
)
def range_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.expr("event_id div 500 * 500")
    return planning.coverage(table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("instrument"), start.alias("start"), (start + 9).alias("end"), F.col("event_id").alias("seq")))


@query(
    """WITH a AS (SELECT DISTINCT user_id, user_id * 10 AS "start", user_id % 3 = 0 AS has_more, user_id % 2 = 0 AS is_expired FROM events),
  p AS (SELECT user_id, max(event_id) AS top, count(*) AS n FROM events WHERE event_id >= user_id * 10 AND user_id % 5 <> 0 GROUP BY 1), j AS (SELECT a.*, top, coalesce(n, 0) AS n FROM a LEFT JOIN p ON a.user_id = p.user_id)
SELECT CAST(user_id AS VARCHAR) AS instrument, n, CASE WHEN n > 0 THEN top + 1 ELSE "start" + 1 END AS next_seq, n > 0 AND (has_more OR n >= 60) AS "continues",
  NOT (n > 0 AND (has_more OR n >= 60)) AND is_expired AS finished FROM j"""
)
def cursor_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, user = table(spark, sf_dir, "events"), F.col("user_id")
    asked = rows.select(user.cast("string").alias("instrument"), (user * 10).alias("start"), (user % 3 == 0).alias("has_more"), (user % 2 == 0).alias("is_expired")).distinct()
    pages = rows.where("event_id >= user_id * 10 and user_id % 5 <> 0").select(user.cast("string").alias("instrument"), F.col("event_id").alias("seq"))
    return planning.cursor(pages, asked, 60)


# ----------------------------------------------------------------- ledger


def _options(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(key.cast("string").alias("instrument"), (key % 100).alias("last_no"), (F.col("o_orderstatus") != "O").cast("int").alias("is_expired"), (F.col("o_orderstatus") == "P").cast("int").alias("is_completed"))


OPTION_SQL = META_SQL.replace("AS instrument,", "AS instrument, o_orderkey % 100 AS last_no,")


@query(f"SELECT instrument AS instrument_name, last_no AS max_seq, is_completed = 1 AS is_complete FROM ({OPTION_SQL})")
def option_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.option_targets(_options(spark, sf_dir))


@query(
    f"""{LEDGER_SQL} SELECT m.instrument AS instrument_name, CAST(coalesce(max(CASE WHEN is_done = 1 AND "count" > 0 THEN chunk_no + "count" - 1 ELSE 0 END), 0) AS BIGINT) AS max_seq,
  max(is_completed) = 1 AS is_complete FROM m LEFT JOIN c ON m.instrument = c.instrument GROUP BY 1"""
)
def future_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.future_targets(*future_ledger(spark, sf_dir))


@query(
    f"""WITH m AS (SELECT * FROM ({OPTION_SQL}) WHERE CAST(instrument AS BIGINT) % 2 = 0), n AS (SELECT CAST(o_orderkey AS VARCHAR) AS instrument, CAST(o_orderkey % 3 = 0 AS INT) AS e FROM orders WHERE o_orderkey % 5 <> 0)
SELECT coalesce(m.instrument, n.instrument) AS instrument, coalesce(last_no, 0) AS last_no, coalesce(e, is_expired) AS is_expired, coalesce(is_completed, 0) AS is_completed FROM m FULL OUTER JOIN n ON m.instrument = n.instrument"""
)
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _even(_options(spark, sf_dir))
    key = F.col("o_orderkey")
    listed = table(spark, sf_dir, "orders").where(key % 5 != 0).select(key.cast("string").alias("instrument"), (key % 3 == 0).cast("int").alias("is_expired"))
    return ledger.upsert(known, listed)


@query(f"{LEDGER_SQL} SELECT * FROM c WHERE chunk_no < 4 UNION ALL SELECT instrument, chunk_no, 0, NULL, 0 FROM c WHERE chunk_no >= 4 AND CAST(instrument AS BIGINT) % 2 = 0")
def chunk_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, chunks = future_ledger(spark, sf_dir)
    return ledger.insert_chunks(chunks.where("chunk_no < 4"), _even(chunks))


@query(f"""{LEDGER_SQL} SELECT instrument, chunk_no, CASE WHEN chunk_no % 2 = 0 THEN "count" * 100 ELSE "count" END AS "count", CASE WHEN chunk_no % 2 = 0 THEN 0 ELSE has_more END AS has_more, is_done FROM c""")
def chunk_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, chunks = future_ledger(spark, sf_dir)
    seen = chunks.where("chunk_no % 2 = 0").select("instrument", "chunk_no", (F.col("count") * 100).alias("count"), F.lit(0).alias("has_more"))
    return ledger.update_chunks(chunks, seen)


@query(f"""{LEDGER_SQL} SELECT c.instrument, chunk_no, "count", has_more, CASE WHEN has_more = 0 AND ("count" >= 2 OR is_expired = 1) THEN 1 ELSE is_done END AS is_done FROM c LEFT JOIN m ON c.instrument = m.instrument""")
def finalize_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, chunks = future_ledger(spark, sf_dir)
    return ledger.finalize_chunks(chunks, meta, 2)


@query(
    f"""{LEDGER_SQL} SELECT instrument, is_expired, CASE WHEN is_expired = 1 AND instrument IN (SELECT instrument FROM c) AND NOT EXISTS (SELECT 1 FROM c WHERE c.instrument = m.instrument AND is_done = 0) THEN 1 ELSE is_completed END AS is_completed FROM m"""
)
def finalize_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.finalize_meta(*future_ledger(spark, sf_dir))


@query(f"SELECT instrument, is_expired, CASE WHEN CAST(instrument AS BIGINT) % 7 = 0 THEN 1 ELSE is_completed END AS is_completed FROM ({META_SQL})")
def mark_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, _ = future_ledger(spark, sf_dir)
    return ledger.mark_complete(meta, meta.where(F.col("instrument").cast("long") % 7 == 0))


@query(f"SELECT instrument, CASE WHEN CAST(instrument AS BIGINT) % 3 = 0 THEN greatest(last_no, CAST(instrument AS BIGINT) % 90) ELSE last_no END AS last_no, is_expired, is_completed FROM ({OPTION_SQL})")
def monotone_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _options(spark, sf_dir)
    key = F.col("instrument").cast("long")
    return ledger.advance(meta, meta.where(key % 3 == 0).select("instrument", (key % 90).alias("last_no")))


@query(f"SELECT * FROM ({META_SQL}) WHERE is_completed = 0")
def incomplete_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.incomplete(future_ledger(spark, sf_dir)[0])


@query(f"{LEDGER_SQL} SELECT * FROM c WHERE is_done = 0")
def pending_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.pending(future_ledger(spark, sf_dir)[1])


@query("SELECT CAST(s AS INT) AS status, s IN (408, 429) OR s >= 500 AS retry FROM range(100, 600) AS r(s)")
def retry_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = spark.range(100, 600).select(F.col("id").cast("int").alias("status"))
    return codes.select("status", projection.retryable(F.col("status")).alias("retry"))


# ----------------------------------------------------------------- streams and files


@query("SELECT user_id AS instrument_name, event_id AS trade_seq FROM events GROUP BY 1, 2")
def streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, deduplicated by a stream that takes what is there and stops."""
    from tallyline.streaming import dedup as stream

    folder = scratch(spark, "stream")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("instrument_name"), F.col("event_id").alias("trade_seq"))
    for _ in range(2):
        rows.write.mode("append").parquet(f"{folder}/in")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    stream.run_available(stream.first_seen(arriving), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS instrument_name, CAST(l_linenumber AS BIGINT) AS trade_seq, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1, 2")
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON lines, read strictly, and deduplicated in the order of files and positions."""
    from tallyline.sources import raw

    folder = f"{scratch(spark, 'raw')}/raw"
    raw.append(canonical_projection(spark, sf_dir), folder)
    rows = spark.read.schema(canonical_projection(spark, sf_dir).schema).option("mode", "FAILFAST").json(folder)
    ranked = rows.select("*", F.struct(*(o.alias(f"o{i}") for i, o in enumerate(dedup.survivor_order(100 << 20)))).alias("at"))
    kept = dedup.first_wins(dedup.guarded(ranked), ["at"])
    return kept.groupBy("instrument_name", "trade_seq").agg(F.count("*").alias("n"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: beneath spark.checkpoint.dir, or a local one where that is unset."""
    import tempfile
    import uuid

    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or f"file://{tempfile.mkdtemp(prefix='tallyline-')}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
