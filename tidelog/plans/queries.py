"""Queries over the synthetic tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import changes, incremental, ledger, merge, schema, stats
from ..sources import dynamic
from ..storage import json_rows as encoded_rows
from .registry import query, read

NOW = 1_000_000_000


# --- simulated logs over events: key user_id, commits of ten events -----------------------------


def log(spark, d) -> DataFrame:
    e = read(spark, d, "events")
    op = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "signup", "insert").otherwise("update")
    return e.select("event_id", "user_id", "event_type", "value", "props", X.micros("ts").alias("ts_us"), op.alias("op"), F.lit("events").alias("table"),
                    F.expr("event_id div 10").alias("sequence"), (F.col("event_id") % 10).alias("tx_ordinal"))


LOG = """WITH log AS (SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS ts_us,
  CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS op, 'events' AS "table",
  event_id // 10 AS sequence, event_id % 10 AS tx_ordinal FROM events) """


#: Every status, stage, retry class and kind of error meets every other one in the jobs.
_STATUS = ("pending", "succeeded", "running", "failed", "pending", "succeeded")
_STAGE = ("loaded", "received", "staged", "applying", "loaded", "applied", "failed", "blocked", "apply_pending", "loaded", "received")
_CLASS = ("permanent", "backpressure", "transient", None)
_ERROR = (None, f"{ledger.HANDOFF} of t", ledger.HANDOFF, f"x {ledger.HANDOFF}", "other")


def _list(xs) -> str:
    return "[" + ", ".join("NULL" if x is None else f"'{x}'" for x in xs) + "]"


def jobs(spark, d) -> DataFrame:
    e = read(spark, d, "events")
    i = F.col("event_id")
    of = lambda xs, n: F.element_at(F.array(*[F.lit(x) for x in xs]), (n % len(xs) + 1).cast("int"))
    j = e.select(
        F.when(i % 10 == 9, "c2").otherwise("c1").alias("connection_id"), F.concat(F.lit("j"), F.lpad(i.cast("string"), 10, "0")).alias("job_id"), F.col("event_type").alias("table_key"),
        F.expr("event_id div 3").alias("first_sequence"), of(_STATUS, i).alias("status"), of(_STAGE, i).alias("stage"),
        F.concat(F.lit('{"steps":[{"row_count":'), (i % 97).cast("string"), F.lit('},{"row_count":'), (i % 13).cast("string"), F.lit("}]}")).alias("payload_json"),
        (i % 7).cast("int").alias("attempt_count"), F.when(i % 6 == 3, of(_CLASS, F.floor(i / 6))).alias("retry_class"), of(_ERROR, i).alias("last_error"),
        F.when(i % 41 == 0, "truncate").alias("barrier_kind"), (i % 43 != 0).alias("reducer_eligible"),
        (F.lit(NOW) - i * 50).alias("created_at"), (F.lit(NOW) - i * 50 + (i % 1000)).alias("updated_at"),
    )
    return j


JOBS = f"""WITH jobs AS (SELECT CASE WHEN event_id % 10 = 9 THEN 'c2' ELSE 'c1' END AS connection_id, 'j' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS job_id, event_type AS table_key, event_id // 3 AS first_sequence,
  {_list(_STATUS)}[event_id % 6 + 1] AS status, {_list(_STAGE)}[event_id % 11 + 1] AS stage, {_list(_ERROR)}[event_id % 5 + 1] AS last_error,
  event_id % 97 + event_id % 13 AS step_rows, CAST(event_id % 7 AS INTEGER) AS attempt_count, CASE WHEN event_id % 6 = 3 THEN {_list(_CLASS)}[event_id // 6 % 4 + 1] END AS retry_class,
  CASE WHEN event_id % 41 = 0 THEN 'truncate' END AS barrier_kind, event_id % 43 <> 0 AS reducer_eligible, {NOW} - event_id * 50 AS created_at, {NOW} - event_id * 50 + event_id % 1000 AS updated_at FROM events) """


def fragments(spark, d) -> DataFrame:
    i = F.col("event_id")
    return read(spark, d, "events").select(
        F.lit("c1").alias("connection_id"), F.concat(F.lit("f"), F.lpad(i.cast("string"), 10, "0")).alias("fragment_id"), F.concat(F.lit("j"), F.expr("event_id div 4").cast("string")).alias("job_id"),
        F.expr("event_id div 5").alias("sequence"), F.col("event_type").alias("table_key"), F.when(i % 2 == 0, "a").alias("lane"),
        F.when(i % 389 == 388, "failed").when(i % 211 == 210, "pending").otherwise("succeeded").alias("status"), (F.lit(NOW) - i).alias("created_at"), (F.lit(NOW) + i % 500).alias("updated_at"),
    )


FRAGMENTS = f"""WITH fragments AS (SELECT 'c1' AS connection_id, 'f' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS fragment_id, 'j' || CAST(event_id // 4 AS VARCHAR) AS job_id, event_id // 5 AS sequence,
  event_type AS table_key, CASE WHEN event_id % 2 = 0 THEN 'a' END AS lane, CASE WHEN event_id % 389 = 388 THEN 'failed' WHEN event_id % 211 = 210 THEN 'pending' ELSE 'succeeded' END AS status,
  {NOW} - event_id AS created_at, {NOW} + event_id % 500 AS updated_at FROM events) """


def sequences(spark, d) -> DataFrame:
    """One row per commit, expecting the distinct fragments that it has."""
    f = fragments(spark, d)
    return f.groupBy("connection_id", "sequence").agg(F.countDistinct("table_key", F.coalesce("lane", F.lit(""))).alias("expected_fragments")).withColumn("commit_lsn", F.concat(F.lit("0/"), F.hex("sequence")))


def orders_cdc(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    return o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 2 = 0").withColumn("price", F.col("price") + 1)


# --- change application ---------------------------------------------------------------------------


@query(LOG + "SELECT user_id, event_id, event_type, op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sequence DESC, tx_ordinal DESC) AS rn FROM log) WHERE rn = 1")
def latest_row_per_key(spark, d):
    return changes.latest(log(spark, d), ["user_id"], *changes.newest_first()).select("user_id", "event_id", "event_type", "op")


@query(LOG + "SELECT op, count(*) AS actions, CAST(sum(event_id) AS BIGINT) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sequence DESC, tx_ordinal DESC) AS rn FROM log) WHERE rn = 1 GROUP BY op")
def compact_events(spark, d):
    return changes.compact(log(spark, d), ["user_id"], True).groupBy("op").agg(F.count("*").alias("actions"), F.sum("event_id").alias("ids"))


@query(LOG + f"SELECT user_id, event_id, CASE WHEN op = 'delete' THEN {NOW} END AS deleted_at, {NOW} AS synced_at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sequence DESC, tx_ordinal DESC) AS rn FROM log) WHERE rn = 1")
def soft_delete_tombstones(spark, d):
    last = changes.compact(log(spark, d), ["user_id"], True)
    return changes.with_tombstones(last, F.lit(NOW)).select("user_id", "event_id", "deleted_at", "synced_at")


@query(LOG + "SELECT user_id, event_id, op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sequence DESC, tx_ordinal DESC) AS rn FROM log WHERE op <> 'delete') WHERE rn = 1")
def hard_delete_ignored(spark, d):
    return changes.compact(log(spark, d), ["user_id"], False).select("user_id", "event_id", "op")


@query(LOG.rstrip() + """, marked AS (SELECT event_id, user_id, event_type AS tbl, CASE WHEN event_id % 997 = 5 THEN 'truncate' ELSE op END AS op FROM log),
cuts AS (SELECT tbl, max(event_id) FILTER (WHERE op = 'truncate') AS cut FROM marked GROUP BY tbl),
kept AS (SELECT m.*, c.cut IS NOT NULL AS truncated FROM marked m JOIN cuts c USING (tbl) WHERE c.cut IS NULL OR m.event_id > c.cut)
SELECT tbl, user_id, event_id, op, truncated FROM (SELECT *, row_number() OVER (PARTITION BY tbl, user_id ORDER BY event_id DESC) AS rn FROM kept) WHERE rn = 1""")
def truncate_barrier_compaction(spark, d):
    m = log(spark, d).withColumn("op", F.when(F.col("event_id") % 997 == 5, "truncate").otherwise(F.col("op"))).withColumn("table", F.col("event_type"))
    return changes.compact(changes.after_truncate(m), ["table", "user_id"], True).select(F.col("table").alias("tbl"), "user_id", "event_id", "op", "truncated")


@query(LOG + "SELECT sequence, event_type AS tbl, count(*) AS events, min(tx_ordinal) AS first_ordinal FROM log GROUP BY 1, 2")
def split_commit_by_table(spark, d):
    return changes.split_by_table(log(spark, d).withColumn("table", F.col("event_type"))).withColumnRenamed("table", "tbl")


@query(LOG + "SELECT event_id, row_number() OVER (PARTITION BY sequence ORDER BY event_id) - 1 AS ordinal FROM log")
def tx_ordinals(spark, d):
    return changes.tx_ordinals(log(spark, d), "sequence", "event_id").select("event_id", "ordinal")


@query(LOG + "SELECT event_type, sequence, dense_rank() OVER (PARTITION BY event_type ORDER BY sequence) - 1 + 100 AS commit_sequence FROM (SELECT DISTINCT event_type, sequence FROM log)")
def commit_sequences(spark, d):
    c = log(spark, d).select("event_type", "sequence").distinct()
    return changes.commit_sequences(c, "sequence", 100, "event_type").select("event_type", "sequence", "commit_sequence")


@query(LOG + "SELECT event_id, sequence AS _sequence, tx_ordinal AS _tx_ordinal, CASE WHEN op = 'delete' THEN 'delete' ELSE 'upsert' END AS _operation FROM log")
def staging_frame(spark, d):
    return changes.staging(log(spark, d)).select("event_id", "_sequence", "_tx_ordinal", "_operation")


@query(LOG + "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN CASE WHEN event_id % 8 = 0 THEN NULL ELSE event_type END ELSE props END AS props FROM log")
def toast_carry_forward(spark, d):
    old = F.when(F.col("event_id") % 8 == 0, None).otherwise(F.col("event_type"))
    return log(spark, d).select("event_id", X.carried(old, F.col("props"), F.col("event_id") % 4 == 0).alias("props"))


ORDERS = "WITH t AS (SELECT o_orderkey, o_custkey, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS price FROM orders WHERE o_orderkey % 2 = 0) "
UPSERT = "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey) UNION ALL SELECT * FROM s"


@query(ORDERS + UPSERT)
def upsert_merge(spark, d):
    return merge.upsert(*orders_cdc(spark, d), "o_orderkey")


@query(ORDERS + UPSERT)
def merge_pk_range(spark, d):
    return merge.merge_in_range(*orders_cdc(spark, d), "o_orderkey")


@query("WITH t AS (SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS k, o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS k, o_orderkey AS id FROM orders WHERE o_orderkey % 2 = 0) SELECT k, id FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k) UNION ALL SELECT k, id FROM s")
def merge_null_pk(spark, d):
    t, s = orders_cdc(spark, d)
    key = lambda df, n: df.select(F.when(F.col("o_orderkey") % n != 0, F.col("o_orderkey")).alias("k"), F.col("o_orderkey").alias("id"))
    return merge.upsert(key(t, 5), key(s, 7), "k")


@query(LOG + """, t AS (SELECT user_id, min(event_id) AS event_id FROM log WHERE user_id % 2 = 0 GROUP BY user_id), steps AS (SELECT user_id, event_id, sequence, tx_ordinal FROM log WHERE event_id % 3 = 0 UNION ALL SELECT user_id, event_id, sequence, tx_ordinal FROM log WHERE event_id % 3 = 1),
s AS (SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sequence DESC, tx_ordinal DESC) AS rn FROM steps) WHERE rn = 1)
SELECT user_id, event_id FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = t.user_id) UNION ALL SELECT user_id, event_id FROM s""")
def reducer_merge_union(spark, d):
    rows = log(spark, d).select("user_id", "event_id", "sequence", "tx_ordinal")
    t = rows.where("user_id % 2 = 0").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    return merge.reducer_merge(t, [rows.where("event_id % 3 = 0"), rows.where("event_id % 3 = 1")], "user_id")


@query(LOG + """, t AS (SELECT user_id, max(ts_us) AS event_at, lpad(CAST(max(event_id) AS VARCHAR), 12, '0') AS event_id, CAST(NULL AS BIGINT) AS deleted_at FROM log WHERE user_id % 3 <> 0 AND event_id % 2 = 0 GROUP BY user_id),
s AS (SELECT user_id, ts_us AS event_at, lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, CASE WHEN op = 'delete' THEN ts_us END AS deleted_at FROM log WHERE event_id % 5 = 1),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_at DESC NULLS LAST, event_id DESC NULLS LAST, deleted_at DESC NULLS LAST) AS rn FROM s) WHERE rn = 1),
j AS (SELECT t.user_id AS tu, r.user_id AS ru, t.event_at AS te, r.event_at AS re, t.event_id AS ti, r.event_id AS ri, r.deleted_at AS rd, coalesce(t.event_at IS NULL OR r.event_at > t.event_at OR (r.event_at = t.event_at AND r.event_id >= t.event_id), false) AS newer FROM t FULL JOIN r ON t.user_id = r.user_id)
SELECT CASE WHEN tu IS NULL OR (ru IS NOT NULL AND newer) THEN ru ELSE tu END AS user_id, CASE WHEN tu IS NULL OR (ru IS NOT NULL AND newer) THEN re ELSE te END AS event_at,
 CASE WHEN tu IS NULL OR (ru IS NOT NULL AND newer) THEN ri ELSE ti END AS event_id, CASE WHEN tu IS NULL OR (ru IS NOT NULL AND newer) THEN rd END AS deleted_at FROM j WHERE NOT (tu IS NULL AND rd IS NOT NULL)""")
def event_time_merge(spark, d):
    rows = log(spark, d).select("user_id", F.col("ts_us").alias("event_at"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"), F.when(F.col("op") == "delete", F.col("ts_us")).alias("deleted_at"), F.col("event_id").alias("i"))
    t = rows.where("user_id % 3 <> 0 and i % 2 = 0").groupBy("user_id").agg(F.max("event_at").alias("event_at"), F.max("event_id").alias("event_id"), F.lit(None).cast("long").alias("deleted_at"))
    return merge.event_time_merge(t, rows.where("i % 5 = 1").drop("i"), "user_id")


# --- scans ------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500")
def full_refresh_page(spark, d):
    return incremental.page(read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey", 1000, 500, "o_orderstatus <> 'P'").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, epoch_us(o_orderdate) AS at_us FROM orders WHERE epoch_us(o_orderdate) > 852076800000000 ORDER BY o_orderdate, o_orderkey LIMIT 700")
def incremental_slice(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", X.micros("o_orderdate").alias("at_us"))
    return incremental.slice_after(o, "at_us", "o_orderkey", 852076800000000, None, 700)


@query("SELECT o_orderkey, epoch_us(o_orderdate) AS at_us FROM orders WHERE epoch_us(o_orderdate) > 852076800000000 OR (epoch_us(o_orderdate) = 852076800000000 AND o_orderkey > 300)")
def incremental_tie_break(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", X.micros("o_orderdate").alias("at_us"))
    return incremental.after_cursor(o, "at_us", "o_orderkey", 852076800000000, 300)


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0")
def row_filter_scan(spark, d):
    return read(spark, d, "customer").where("c_mktsegment = 'BUILDING' and c_acctbal > 0").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def column_selection(spark, d):
    c = read(spark, d, "customer")
    return c.select(*schema.select_columns(c.columns, ["c_name", "c_acctbal"], ["c_mktsegment"], ["c_custkey"]))


@query("SELECT count(*) AS row_count, min(o_orderkey) AS min_pk, max(o_orderkey) AS max_pk FROM orders")
def chunk_bounds(spark, d):
    return incremental.bounds(read(spark, d, "orders"), "o_orderkey")


CHUNKS = """WITH b AS (SELECT count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders), p AS (SELECT lo, hi, least(4, hi - lo + 1) AS k FROM b WHERE n >= 10 * 8 * 4 AND lo < hi),
q AS (SELECT lo, hi, k, CAST(ceil((hi - lo + 1) / k) AS BIGINT) AS step FROM p),
c AS (SELECT i AS chunk, lo + i * step AS range_start, CASE WHEN i = k - 1 THEN hi ELSE lo + (i + 1) * step - 1 END AS range_end FROM q, range(4) t(i) WHERE i < k) """


@query(CHUNKS + "SELECT CAST(chunk AS BIGINT) AS chunk, CAST(range_start AS BIGINT) AS range_start, CAST(range_end AS BIGINT) AS range_end FROM c")
def chunk_plan(spark, d):
    return incremental.chunk_table(incremental.bounds(read(spark, d, "orders"), "o_orderkey"), 10, 4)


@query(CHUNKS + "SELECT CAST(chunk AS BIGINT) AS chunk, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders JOIN c ON o_orderkey BETWEEN range_start AND range_end GROUP BY 1")
def chunk_scan_union(spark, d):
    o = read(spark, d, "orders").select("o_orderkey")
    n, low, high = incremental.bounds(o, "o_orderkey").first()
    parts = [incremental.chunk_rows(o, "o_orderkey", c).withColumn("chunk", F.lit(i).cast("long")) for i, c in enumerate(incremental.plan_chunks(n, low, high, 10, 4))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("chunk").agg(F.count("*").alias("row_count"), F.sum("o_orderkey").alias("keys"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 501 AND 900 AND o_orderkey > 650")
def chunk_resume(spark, d):
    left = incremental.to_resume([incremental.Chunk(1, 500, 500, True), incremental.Chunk(501, 900, 650)])
    return incremental.chunk_rows(read(spark, d, "orders").select("o_orderkey"), "o_orderkey", left[0])


@query("SELECT count(*) AS row_count, max(epoch_us(o_orderdate)) AS max_updated_at FROM orders WHERE o_orderstatus = 'F'")
def source_summary(spark, d):
    return incremental.source_summary(read(spark, d, "orders").select("o_orderstatus", X.micros("o_orderdate").alias("at")), "at", "o_orderstatus = 'F'")


@query(LOG + "SELECT count(*) AS row_count, max(ts_us) AS max_synced_at, count(*) FILTER (WHERE op = 'delete') AS deleted_rows FROM log")
def destination_summary(spark, d):
    return incremental.destination_summary(log(spark, d).select(F.col("ts_us").alias("synced_at"), F.when(F.col("op") == "delete", 1).alias("deleted_at")))


@query("""WITH s AS (SELECT event_type AS table_key, count(*) AS source_rows FROM events WHERE event_type <> 'view' AND value > 10 GROUP BY 1),
d AS (SELECT event_type AS table_key, count(*) AS dest_rows, count(*) FILTER (WHERE value <= 10) AS dest_deleted FROM events WHERE event_type <> 'click' GROUP BY 1)
SELECT coalesce(s.table_key, d.table_key) AS table_key, source_rows, dest_rows, dest_deleted, coalesce(source_rows = dest_rows - coalesce(dest_deleted, 0), false) AS count_match FROM s FULL JOIN d ON s.table_key = d.table_key""")
def reconcile_counts(spark, d):
    e = read(spark, d, "events").select(F.col("event_type").alias("table_key"), "value")
    s = e.where("table_key <> 'view' and value > 10").groupBy("table_key").agg(F.count("*").alias("source_rows"))
    t = e.where("table_key <> 'click'").groupBy("table_key").agg(F.count("*").alias("dest_rows"), F.count_if(F.col("value") <= 10).alias("dest_deleted"))
    return stats.reconciled(s, t, True)


# --- ledger -----------------------------------------------------------------------------------------

_HANDOFF = ledger.HANDOFF
_WHEN = {f"{x}_jobs": f"status = '{x}'" for x in ("pending", "running", "succeeded", "failed")} | {
    "failed_retryable_jobs": "status = 'failed' AND retry_class IN ('backpressure','transient')", "failed_permanent_jobs": "status = 'failed' AND retry_class = 'permanent'",
    "failed_snapshot_handoff_jobs": f"status = 'failed' AND retry_class IN ('backpressure','transient') AND last_error LIKE '{_HANDOFF}%'",
    "failed_unclassified_jobs": "status = 'failed' AND (retry_class IS NULL OR retry_class NOT IN ('backpressure','transient','permanent'))",
    "received_jobs": "stage = 'received'", "staged_jobs": "stage = 'staged'", "loaded_jobs": "stage = 'loaded'", "blocked_jobs": "stage = 'blocked'",
    "snapshot_handoff_waiting_jobs": f"stage = 'blocked' AND last_error LIKE '{_HANDOFF}%'", "applying_jobs": "stage = 'applying'", "applied_jobs": "stage = 'applied'",
    "failed_stage_jobs": "stage = 'failed'", "jobs_per_minute": f"status = 'succeeded' AND updated_at >= {NOW - 60000}",
}
_AGES = {"pending": ("created_at", "status = 'pending'"), "running": ("updated_at", "status = 'running'")} | {x: ("updated_at", f"stage = '{x}'") for x in ("received", "loaded", "blocked", "applying")}
_SUMMARY = ", ".join(
    [f"count(*) FILTER (WHERE {w}) AS {k}" for k, w in _WHEN.items()]
    + [f"CAST(greatest({NOW} - min({c}) FILTER (WHERE {w}), 0) // 1000 AS BIGINT) AS oldest_{k}_age_s" for k, (c, w) in _AGES.items()]
)


@query(JOBS + f"""SELECT connection_id, count(*) AS total_jobs, {_SUMMARY}, round(avg(updated_at - created_at) FILTER (WHERE status = 'succeeded' AND updated_at >= {NOW - 900000}), 3) AS avg_job_duration_ms FROM jobs GROUP BY 1""")
def queue_summary(spark, d):
    return ledger.queue_summary(jobs(spark, d), NOW)


@query(JOBS + "SELECT table_key, count(*) AS queued_jobs, CAST(sum(step_rows) AS BIGINT) AS queued_rows FROM jobs WHERE connection_id = 'c1' AND status IN ('pending','running') GROUP BY 1 ORDER BY 3 DESC, 2 DESC, 1 LIMIT 5")
def top_queued_tables(spark, d):
    return ledger.top_queued(jobs(spark, d), "c1")


@query(JOBS + f"SELECT table_key, count(*) AS succeeded_jobs, CAST(sum(step_rows) AS BIGINT) AS loaded_rows, CAST(sum(updated_at - created_at) AS BIGINT) AS total_ms FROM jobs WHERE connection_id = 'c1' AND status = 'succeeded' AND updated_at >= {NOW - 900000} GROUP BY 1 ORDER BY 4 DESC, 2 DESC, 1 LIMIT 5")
def top_loaded_tables(spark, d):
    return ledger.top_loaded(jobs(spark, d), "c1", NOW)


@query(JOBS + f"SELECT CAST(coalesce(sum(step_rows), 0) AS BIGINT) AS rows_per_minute FROM jobs WHERE connection_id = 'c1' AND status = 'succeeded' AND updated_at >= {NOW - 60000}")
def rows_per_minute(spark, d):
    return ledger.rows_per_minute(jobs(spark, d), "c1", NOW)


_PENDING = f"SELECT {{0}} AS ledger, count(*) AS pending, min(created_at) AS oldest, coalesce(count(*) >= {{2}} OR greatest({NOW} - min(created_at), 0) >= 50000000, false) AS exceeded FROM {{1}} WHERE connection_id = 'c1' AND status = 'pending'"


@query(FRAGMENTS + ", " + JOBS.removeprefix("WITH ") + ", p AS (" + _PENDING.format("0", "fragments", 100_000) + " UNION ALL " + _PENDING.format("1", "jobs", 100) + ") SELECT CASE ledger WHEN 0 THEN 'fragments' ELSE 'jobs' END AS ledger, pending, oldest FROM p WHERE exceeded ORDER BY p.ledger LIMIT 1")
def backpressure(spark, d):
    """The jobs exceed their bound, the fragments do not."""
    return ledger.backpressure(fragments(spark, d), jobs(spark, d), "c1", NOW, 100_000, 100, 50_000_000)


@query(FRAGMENTS + "SELECT job_id, count(*) AS total, count(*) FILTER (WHERE status = 'succeeded') AS durable, count(*) FILTER (WHERE status = 'failed') AS failed FROM fragments GROUP BY 1")
def job_completeness(spark, d):
    return ledger.completeness(fragments(spark, d))


PROGRESS = FRAGMENTS + """, sequences AS (SELECT connection_id, sequence, '0/' || to_hex(sequence) AS commit_lsn, count(DISTINCT table_key || '|' || coalesce(lane, '')) AS expected_fragments FROM fragments GROUP BY 1, 2),
progress AS (SELECT s.connection_id, s.sequence, s.commit_lsn, s.expected_fragments, count(DISTINCT f.table_key || '|' || coalesce(f.lane, '')) FILTER (WHERE f.status = 'succeeded') AS succeeded_fragments FROM sequences s LEFT JOIN fragments f USING (connection_id, sequence) GROUP BY ALL) """


@query(PROGRESS + "SELECT * FROM progress")
def distinct_fragments(spark, d):
    return ledger.fragment_progress(sequences(spark, d), fragments(spark, d))


@query(PROGRESS + """, w AS (SELECT *, max(CASE WHEN sequence <> 5 + rn - 1 OR succeeded_fragments < greatest(expected_fragments, 1) THEN 1 ELSE 0 END) OVER (ORDER BY sequence) AS stop FROM (SELECT *, row_number() OVER (ORDER BY sequence) AS rn FROM progress WHERE sequence >= 5 AND sequence < 1005))
SELECT connection_id, 5 + count(*) AS next_sequence, arg_max(commit_lsn, sequence) AS commit_lsn FROM w WHERE stop = 0 GROUP BY 1""")
def contiguous_frontier(spark, d):
    return ledger.frontier(ledger.fragment_progress(sequences(spark, d), fragments(spark, d)), 5, 1000)


@query(JOBS + "SELECT connection_id, table_key, job_id, first_sequence FROM (SELECT *, row_number() OVER (PARTITION BY connection_id, table_key ORDER BY first_sequence, created_at, job_id) AS rn FROM jobs WHERE status IN ('pending','running','failed')) WHERE rn = 1")
def ready_heads(spark, d):
    return ledger.heads(jobs(spark, d)).select("connection_id", "table_key", "job_id", "first_sequence")


#: Jobs of many tables: each table's first ones have succeeded, then come loaded ones with here and there one that blocks.
_QUEUE = JOBS + f""", queue AS (SELECT connection_id, job_id, event_id % 211 AS table_key, event_id AS first_sequence, {NOW} - event_id AS created_at, {NOW} - event_id % 4001 AS updated_at,
  CASE WHEN event_id < event_id % 211 * 17 THEN 'succeeded' WHEN event_id % 59 = 3 THEN 'running' WHEN event_id % 61 = 3 THEN 'failed' ELSE 'pending' END AS status,
  CASE WHEN event_id % 53 = 3 THEN 'received' ELSE 'loaded' END AS stage, CASE WHEN event_id % 41 = 0 THEN 'truncate' END AS barrier_kind, event_id % 43 <> 0 AS reducer_eligible
  FROM (SELECT connection_id, job_id, CAST(substr(job_id, 2) AS BIGINT) AS event_id FROM jobs)) """


def queue(spark, d) -> DataFrame:
    i = F.substr("job_id", F.lit(2)).cast("long")
    status = F.when(i < i % 211 * 17, "succeeded").when(i % 59 == 3, "running").when(i % 61 == 3, "failed").otherwise("pending")
    return jobs(spark, d).select(
        "connection_id", "job_id", (i % 211).alias("table_key"), i.alias("first_sequence"), (F.lit(NOW) - i).alias("created_at"), (F.lit(NOW) - i % 4001).alias("updated_at"), status.alias("status"),
        F.when(i % 53 == 3, "received").otherwise("loaded").alias("stage"), "barrier_kind", "reducer_eligible",
    )


_FITS = "{0}.status = 'pending' AND {0}.stage = 'loaded' AND {0}.barrier_kind IS NULL AND {0}.reducer_eligible"
WINDOW = f""", h AS (SELECT * FROM queue WHERE status IN ('pending','running','failed') QUALIFY row_number() OVER (PARTITION BY connection_id, table_key ORDER BY first_sequence, created_at, job_id) = 1),
head AS (SELECT * FROM h WHERE (status = 'pending' AND stage = 'loaded') OR (status = 'running' AND updated_at < {NOW - 1000})),
candidates AS (SELECT j.*, head.job_id AS head_id, head.status = 'running' OR head.updated_at <= {NOW - 2000} OR head.barrier_kind IS NOT NULL OR NOT head.reducer_eligible AS head_ready
  FROM queue j JOIN head USING (connection_id, table_key)
  WHERE j.job_id = head.job_id OR (head.barrier_kind IS NULL AND head.reducer_eligible AND {_FITS.format("j")} AND j.first_sequence > head.first_sequence
    AND NOT EXISTS (SELECT 1 FROM queue b WHERE b.connection_id = j.connection_id AND b.table_key = j.table_key AND b.job_id <> head.job_id
      AND b.first_sequence >= head.first_sequence AND b.first_sequence < j.first_sequence AND NOT ({_FITS.format("b")})))),
placed AS (SELECT *, row_number() OVER (PARTITION BY connection_id, table_key ORDER BY first_sequence, created_at, job_id) AS place,
  head_ready OR count(*) OVER (PARTITION BY connection_id, table_key) >= 5 AS ready FROM candidates) """


@query(_QUEUE + WINDOW + "SELECT connection_id, table_key, job_id, head_id, place, ready FROM placed WHERE place <= 5")
def reducer_window(spark, d):
    return ledger.windows(queue(spark, d), NOW, NOW - 1_000, 5, 2_000)


@query(_QUEUE + WINDOW + """, first AS (SELECT l.connection_id, l.job_id FROM queue l WHERE l.job_id IN (SELECT head_id FROM placed WHERE ready) QUALIFY row_number() OVER (PARTITION BY l.connection_id ORDER BY l.first_sequence, l.created_at, l.job_id) = 1)
SELECT p.connection_id, p.table_key, p.job_id, p.place FROM placed p JOIN first ON p.head_id = first.job_id AND p.connection_id = first.connection_id WHERE p.place <= 5""")
def reducer_claim(spark, d):
    return ledger.claim(queue(spark, d), NOW, NOW - 1_000, 5, 2_000)


@query(FRAGMENTS + """, j AS (SELECT DISTINCT job_id, CASE WHEN CAST(substr(job_id, 2) AS BIGINT) % 3 = 0 THEN 'running' ELSE 'succeeded' END AS status FROM fragments)
SELECT job_id FROM j WHERE status = 'running' AND job_id NOT IN (SELECT job_id FROM fragments GROUP BY 1 HAVING count(*) FILTER (WHERE status = 'succeeded') = count(*))""")
def replay_doomed_jobs(spark, d):
    f = fragments(spark, d)
    j = f.select("job_id").distinct().withColumn("status", F.when(F.substr("job_id", F.lit(2)).cast("long") % 3 == 0, "running").otherwise("succeeded"))
    return ledger.doomed(j, f)


@query(FRAGMENTS + """SELECT fragment_id, CASE WHEN CAST(substr(job_id, 2) AS BIGINT) % 3 <> 0 THEN 'succeeded' ELSE status END AS status FROM fragments""")
def replay_repaired_fragments(spark, d):
    f = fragments(spark, d)
    j = f.select("job_id").distinct().withColumn("status", F.when(F.substr("job_id", F.lit(2)).cast("long") % 3 == 0, "running").otherwise("succeeded"))
    return ledger.repaired(f, j).select("fragment_id", "status")


_STATES = FRAGMENTS + ", f AS (SELECT * REPLACE (CASE WHEN sequence % 5 = 0 AND status = 'succeeded' THEN 'running' ELSE status END AS status, created_at + sequence % 3 AS created_at), 'c' || sequence % 7 AS connection, '0/' || to_hex(sequence) AS commit_lsn FROM fragments) "


def states(spark, d) -> DataFrame:
    """Fragments of several connections, some of them running, which no enqueue state counts."""
    status = F.when((F.col("sequence") % 5 == 0) & (F.col("status") == "succeeded"), "running").otherwise(F.col("status"))
    f = fragments(spark, d).withColumns({"status": status, "created_at": F.col("created_at") + F.col("sequence") % 3, "commit_lsn": F.concat(F.lit("0/"), F.hex("sequence"))})
    return f.withColumn("connection_id", F.concat(F.lit("c"), F.col("sequence") % 7))


@query(_STATES + "SELECT connection AS connection_id, sequence, commit_lsn, created_at FROM f WHERE status IN ('pending', 'succeeded', 'failed') QUALIFY row_number() OVER (PARTITION BY connection ORDER BY sequence DESC, created_at DESC) = 1")
def enqueue_latest(spark, d):
    return ledger.enqueue_state(states(spark, d))


@query(FRAGMENTS + "SELECT connection_id, arg_min(fragment_id, struct_pack(a := sequence, b := created_at, c := fragment_id)) FILTER (WHERE status = 'pending') AS oldest_pending, arg_max(fragment_id, struct_pack(a := updated_at, b := sequence, c := fragment_id)) FILTER (WHERE status = 'failed') AS latest_failed, greatest(max(sequence) - 7, 0) AS sequence_lag FROM fragments GROUP BY 1")
def oldest_pending(spark, d):
    return ledger.fragment_ends(fragments(spark, d), 7)


@query(JOBS + "SELECT connection_id, job_id, retry_class, last_error, updated_at FROM jobs WHERE status = 'failed' QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY updated_at DESC, job_id DESC) = 1")
def latest_failed(spark, d):
    return ledger.latest_failed_job(jobs(spark, d)).select("connection_id", "job_id", "retry_class", "last_error", "updated_at")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8")
def hot_tables_top8(spark, d):
    return ledger.hot_tables(read(spark, d, "events"), "user_id")


@query(JOBS + f"SELECT connection_id, job_id FROM jobs WHERE status = 'pending' AND (stage = 'received' OR (stage = 'staged' AND updated_at < {NOW - 90000})) QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY first_sequence, created_at, job_id) = 1")
def staging_claim(spark, d):
    return ledger.staging_claim(jobs(spark, d), NOW - 90_000).select("connection_id", "job_id")


@query(JOBS + f"SELECT job_id FROM jobs WHERE (status = 'running' OR (status = 'pending' AND stage = 'staged')) AND updated_at < {NOW - 90000}")
def stale_reclaim(spark, d):
    return ledger.stale_jobs(jobs(spark, d), NOW).select("job_id")


BACKOFF = "CAST(least(16 * pow(2, least(greatest(attempt_count - 1, 0), 20)), 1024) AS BIGINT)"


@query(JOBS + f"SELECT job_id, attempt_count FROM jobs WHERE status = 'failed' AND retry_class IN ('backpressure','transient') AND updated_at + {BACKOFF} * 1000 <= {NOW}")
def retry_due_jobs(spark, d):
    return ledger.retry_due(jobs(spark, d), NOW, jitter=False).select("job_id", "attempt_count")


@query(JOBS + f"SELECT DISTINCT attempt_count, {BACKOFF} AS seconds FROM jobs")
def backoff_no_jitter(spark, d):
    return jobs(spark, d).select("attempt_count", X.backoff_seconds(F.col("attempt_count")).alias("seconds")).distinct()


@query(JOBS + "SELECT job_id, CASE WHEN stage = 'staged' THEN CASE status WHEN 'pending' THEN 'received' WHEN 'running' THEN 'applying' WHEN 'succeeded' THEN 'applied' ELSE 'failed' END ELSE stage END AS stage FROM jobs WHERE status IN ('pending','failed')")
def ledger_stage_mapping(spark, d):
    return ledger.scan(jobs(spark, d).withColumn("stage", F.when(F.col("stage") != "staged", F.col("stage"))), ["pending", "failed"]).select("job_id", "stage")


@query("""WITH a AS (SELECT event_id AS connection_id, value AS next_sequence, CAST(NULL AS VARCHAR) AS lsn FROM events WHERE event_id % 2 = 0), b AS (SELECT event_id AS connection_id, value + 1 AS next_sequence, props AS lsn FROM events WHERE event_id % 3 = 0), c AS (SELECT event_id AS connection_id, value + 2 AS next_sequence, event_type AS lsn FROM events WHERE event_id % 5 = 0)
SELECT connection_id, coalesce(a.next_sequence, b.next_sequence, c.next_sequence) AS next_sequence, coalesce(a.lsn, b.lsn, c.lsn) AS lsn FROM a FULL JOIN b USING (connection_id) FULL JOIN c USING (connection_id)""")
def watermark_state_coalesce(spark, d):
    e = read(spark, d, "events").withColumnRenamed("event_id", "connection_id")
    part = lambda k, i, lsn: e.where(f"connection_id % {k} = 0").select("connection_id", (F.col("value") + i).alias("next_sequence"), lsn.alias("lsn"))
    return ledger.merged_watermark(part(2, 0, F.lit(None).cast("string")), part(3, 1, F.col("props")), part(5, 2, F.col("event_type")), ["next_sequence", "lsn"])


@query(FRAGMENTS + "SELECT connection_id, sequence, max(e) AS expected_fragments, max(l) AS commit_lsn FROM (SELECT connection_id, sequence, 1 AS e, 'a' AS l FROM fragments UNION ALL SELECT connection_id, sequence, 3, 'b' FROM fragments WHERE sequence % 2 = 0) GROUP BY 1, 2")
def sequence_ledger_upsert(spark, d):
    f = fragments(spark, d).select("connection_id", "sequence")
    one = lambda df, e, lsn: df.withColumn("expected_fragments", F.lit(e)).withColumn("commit_lsn", F.lit(lsn))
    return ledger.merged_sequences(one(f, 1, "a"), one(f.where("sequence % 2 = 0"), 3, "b"))


@query(JOBS + "SELECT job_id, table_key IN ('click', 'view') AS skipped FROM jobs WHERE status = 'pending'")
def blocked_table_skip(spark, d):
    blocked = spark.createDataFrame([("click",), ("view",)], "table_key string")
    go, skip = ledger.without_blocked(jobs(spark, d).where("status = 'pending'"), blocked)
    return go.select("job_id", F.lit(False).alias("skipped")).unionByName(skip.select("job_id", F.lit(True).alias("skipped")))


@query(JOBS + "SELECT job_id FROM jobs WHERE stage IN ('applying', 'blocked') AND table_key <> 'click'")
def handoff_release(spark, d):
    j = jobs(spark, d).withColumn("stage", F.when(F.col("stage") == "applying", "blocked").otherwise(F.col("stage")))
    c = spark.createDataFrame([("click", [(True,), (False,)]), ("view", [(True,)])], "table_key string, chunks array<struct<complete boolean>>")
    return ledger.released(j, c).select("job_id")


# --- statistics --------------------------------------------------------------------------------------


@query("SELECT user_id AS run_id, event_type AS table_key, count(*) AS rows_read, CAST(sum(event_id % 11) AS BIGINT) AS extract_ms FROM events GROUP BY 1, 2")
def run_table_stats(spark, d):
    m = read(spark, d, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("table_key"), F.lit(1).alias("rows_read"), (F.col("event_id") % 11).alias("extract_ms"))
    return stats.run_totals(m, ["run_id", "table_key"], ["rows_read", "extract_ms"])


@query(LOG + """, p AS (SELECT sequence, event_type AS tbl, count(*) AS n, 1000 + sequence % 7 AS total FROM log GROUP BY 1, 2, 4), q AS (SELECT *, CAST(floor(total * n / sum(n) OVER (PARTITION BY sequence)) AS BIGINT) AS share, row_number() OVER (PARTITION BY sequence ORDER BY tbl DESC) AS back FROM p)
SELECT sequence, tbl, CAST(CASE WHEN back = 1 THEN total - coalesce(sum(share) OVER (PARTITION BY sequence ORDER BY tbl ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE share END AS BIGINT) AS attributed_ms FROM q""")
def extract_ms_attribution(spark, d):
    p = log(spark, d).groupBy("sequence", F.col("event_type").alias("tbl")).agg(F.count("*").alias("n")).withColumn("total", 1000 + F.col("sequence") % 7)
    return stats.attributed_ms(p, "sequence", "tbl", "n", "total").select("sequence", "tbl", "attributed_ms")


@query("SELECT event_id, CASE WHEN lag(event_id) OVER w IS NOT NULL THEN round(greatest(floor(value) - lag(floor(value)) OVER w, 0) * CAST(1000.0 AS DOUBLE) / greatest(event_id * 7 - lag(event_id * 7) OVER w, 1), 6) END AS rate FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def throughput_rates(spark, d):
    s = read(spark, d, "events").select("event_id", "user_id", (F.col("event_id") * 7).alias("at_ms"), F.floor("value").cast("double").alias("n"))
    return stats.rates(s, "user_id", "at_ms", "n").select("event_id", "rate")


@query("SELECT event_type, CAST(greatest(2000000000 - max(epoch_us(ts) // 1000000), 0) AS BIGINT) AS age_s FROM events GROUP BY 1")
def checkpoint_age(spark, d):
    c = read(spark, d, "events").groupBy("event_type").agg(F.max(X.micros("ts")).alias("us")).withColumn("synced_s", F.floor(F.col("us") / 1_000_000).cast("long"))
    return stats.checkpoint_age(c, 2_000_000_000).select("event_type", "age_s")


@query("SELECT o_orderkey AS run_id, epoch_us(o_orderdate) AS started_at FROM orders ORDER BY 2 DESC, 1 DESC LIMIT 20")
def recent_runs(spark, d):
    return stats.recent_runs(read(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), X.micros("o_orderdate").alias("started_at")), 20)


_MEASURES = {
    "failed_fragments": 29, "failed_permanent_jobs": 31, "snapshot_handoff_waiting_jobs": 11, "failed_snapshot_handoff_jobs": 13, "failed_retryable_jobs": 5, "failed_unclassified_jobs": 7,
    "rows_per_minute": 17, "jobs_per_minute": 19, "sequence_lag": 3, "pending_fragments": 8, "pending_jobs": 4, "running_jobs": 23,
}
MEASURED = f"""WITH m AS (SELECT event_id, ['ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'disabled', 'failed', NULL][event_id % 15 + 1] AS sampler_status, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS slot_active,
  CASE WHEN event_id % 2 = 0 THEN event_id % 7 * 250000 END AS wal_bytes_behind, CASE WHEN event_id % 10 < 3 THEN event_id % 4 END AS failed_jobs,
  {', '.join(f"CASE WHEN event_id % 9 <> 0 THEN CAST(event_id % {n} = 0 AS BIGINT) END AS {k}" for k, n in _MEASURES.items())} FROM events),
z AS (SELECT event_id, sampler_status, slot_active, {', '.join(f"coalesce({k}, 0) AS {k}" for k in [*_MEASURES, "wal_bytes_behind", "failed_jobs"])}, pending_jobs IS NULL AND pending_fragments IS NULL AS bare FROM m),
q AS (SELECT *, rows_per_minute > 0 OR jobs_per_minute > 0 AS going, pending_fragments = 0 AND pending_jobs = 0 AND running_jobs = 0 AS clear FROM z) """


@query(MEASURED + """SELECT event_id, r.s AS status, r.b AS blocker FROM (SELECT event_id, CASE
  WHEN sampler_status IS DISTINCT FROM 'ok' THEN {'s': 'unknown', 'b': 'cdc_sampler'}
  WHEN failed_fragments > 0 OR failed_permanent_jobs > 0 THEN {'s': 'blocked', 'b': 'failed_work'}
  WHEN snapshot_handoff_waiting_jobs > 0 THEN {'s': if(going, 'moving', 'backlogged'), 'b': 'snapshot_handoff_wait'}
  WHEN failed_snapshot_handoff_jobs > 0 AND failed_snapshot_handoff_jobs = failed_jobs THEN {'s': if(going, 'moving', 'backlogged'), 'b': 'snapshot_handoff_retry'}
  WHEN failed_retryable_jobs > 0 AND failed_retryable_jobs = failed_jobs THEN {'s': if(going, 'moving', 'backlogged'), 'b': 'retryable_job_backoff'}
  WHEN failed_unclassified_jobs > 0 AND failed_unclassified_jobs + failed_retryable_jobs = failed_jobs THEN {'s': if(going, 'watch', 'backlogged'), 'b': 'unclassified_failed_jobs'}
  WHEN failed_jobs > 0 THEN {'s': 'blocked', 'b': 'failed_work'} WHEN going THEN {'s': 'moving', 'b': 'none'}
  WHEN slot_active = false AND wal_bytes_behind >= 1000000 AND clear THEN {'s': 'blocked', 'b': 'slot_inactive'}
  WHEN sequence_lag > 0 AND clear THEN {'s': 'blocked', 'b': 'feedback_gap'} WHEN wal_bytes_behind >= 1000000 AND clear THEN {'s': 'watch', 'b': 'none'}
  WHEN NOT clear THEN {'s': 'backlogged', 'b': 'staging_or_reducer_backlog'} ELSE {'s': 'idle', 'b': 'none'} END AS r FROM q WHERE NOT (sampler_status IS NOT DISTINCT FROM 'disabled' AND bare))""")
def progress_insight(spark, d):
    i = F.col("event_id")
    sampler = F.element_at(F.array(*[F.lit(x) for x in [*["ok"] * 12, "disabled", "failed", None]]), (i % 15 + 1).cast("int"))
    m = {k: F.when(i % 9 != 0, (i % n == 0).cast("long")) for k, n in _MEASURES.items()}
    m |= {"wal_bytes_behind": F.when(i % 2 == 0, i % 7 * 250_000), "failed_jobs": F.when(i % 10 < 3, i % 4)}
    rows = read(spark, d, "events").select("event_id", sampler.alias("sampler_status"), F.when(i % 3 == 0, True).when(i % 3 == 1, False).alias("slot_active"), *[c.alias(k) for k, c in m.items()])
    return stats.insight(rows).select("event_id", "status", "blocker")


_PROGRESS = """WITH p AS (SELECT 't' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS table_key, ['idle', 'error', 'running', 'blocked', NULL][event_id % 5 + 1] AS phase, CASE WHEN event_id % 3 = 0 THEN event_id % 4 END AS snapshot_chunks_total,
  event_id % 2 AS snapshot_chunks_complete, CASE WHEN event_id % 8 = 0 THEN event_id % 16 END AS rows_read FROM events) """


def progress(spark, d) -> DataFrame:
    i = F.col("event_id")
    phase = F.element_at(F.array(*[F.lit(x) for x in ("idle", "error", "running", "blocked", None)]), (i % 5 + 1).cast("int"))
    none = F.lit(None).cast("long")
    return read(spark, d, "events").select(F.concat(F.lit("t"), F.lpad(i.cast("string"), 10, "0")).alias("table_key"), phase.alias("phase"), F.when(i % 3 == 0, i % 4).alias("snapshot_chunks_total"), (i % 2).alias("snapshot_chunks_complete"),
                                           F.when(i % 8 == 0, i % 16).alias("rows_read"), none.alias("rows_written"), none.alias("rows_deleted"), none.alias("rows_upserted"))


@query(_PROGRESS + "SELECT table_key, phase FROM p WHERE phase IN ('error', 'blocked') OR snapshot_chunks_total > 0 OR rows_read > 0 ORDER BY table_key LIMIT 25")
def active_tables(spark, d):
    return stats.active_tables(progress(spark, d)).select("table_key", "phase")


@query(_PROGRESS + "SELECT table_key FROM p WHERE snapshot_chunks_total > 0 AND snapshot_chunks_complete < snapshot_chunks_total ORDER BY table_key LIMIT 25")
def snapshot_tables(spark, d):
    return stats.snapshot_tables(progress(spark, d)).select("table_key")


@query("""WITH c AS (SELECT event_id, ['running', 'failed', 'success', 'running', NULL, 'running'][event_id % 6 + 1] AS status, event_id % 7 = 0 AS open, ['stream', 'cdc', 'cdc', NULL][event_id % 4 + 1] AS kind,
  ['following', 'continuity_lost', 'unknown', 'initializing', NULL][event_id % 5 + 1] AS runtime, ['schema_blocked', 'lock_contention', NULL][event_id % 3 + 1] AS err FROM events)
SELECT event_id, CASE WHEN open AND runtime = 'following' THEN 'mixed' WHEN open THEN 'snapshot' WHEN kind = 'stream' THEN 'kinesis' WHEN kind = 'cdc' THEN 'cdc' ELSE 'scheduled_polling' END AS mode,
  CASE status WHEN 'running' THEN CASE WHEN open THEN 'snapshotting' WHEN kind = 'stream' THEN 'running' ELSE CASE runtime WHEN 'following' THEN 'running' WHEN 'continuity_lost' THEN 'blocked' WHEN 'unknown' THEN 'starting' WHEN 'initializing' THEN 'starting' ELSE 'syncing' END END
    WHEN 'failed' THEN CASE WHEN err = 'schema_blocked' THEN 'blocked' ELSE 'error' END WHEN 'success' THEN 'healthy' ELSE 'idle' END AS phase,
  CASE status WHEN 'running' THEN CASE WHEN open THEN 'snapshot_in_progress' WHEN kind = 'stream' THEN 'kinesis_following' ELSE CASE runtime WHEN 'following' THEN 'cdc_following' WHEN 'continuity_lost' THEN 'cdc_continuity_lost' WHEN 'unknown' THEN 'cdc_state_unknown' WHEN 'initializing' THEN 'cdc_initializing' ELSE 'sync_in_progress' END END
    WHEN 'failed' THEN coalesce(err, 'last_run_failed') WHEN 'success' THEN 'healthy' ELSE 'never_synced' END AS reason FROM c""")
def connection_phase(spark, d):
    i = F.col("event_id")
    of = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (i % len(xs) + 1).cast("int"))
    status, kind = of(["running", "failed", "success", "running", None, "running"]), of(["stream", "cdc", "cdc", None])
    runtime, err = of(["following", "continuity_lost", "unknown", "initializing", None]), of(["schema_blocked", "lock_contention", None])
    phase, reason = stats.connection_phase(status, i % 7 == 0, kind, runtime, err)
    return read(spark, d, "events").select("event_id", stats.connection_mode(i % 7 == 0, kind, runtime).alias("mode"), phase.alias("phase"), reason.alias("reason"))


@query("""WITH c AS (SELECT n_name AS table_key, n_nationkey AS rank FROM nation WHERE n_nationkey % 2 = 0), k AS (SELECT n_name AS table_key, n_regionkey AS saved FROM nation WHERE n_nationkey % 3 = 0), s AS (SELECT n_name AS table_key, length(n_name) AS rows_read FROM nation WHERE n_nationkey % 5 = 0)
SELECT table_key, rank, saved, rows_read FROM c FULL JOIN k USING (table_key) FULL JOIN s USING (table_key)""")
def table_progress(spark, d):
    n = read(spark, d, "nation").withColumnRenamed("n_name", "table_key")
    return stats.table_progress(n.where("n_nationkey % 2 = 0").select("table_key", F.col("n_nationkey").alias("rank")), n.where("n_nationkey % 3 = 0").select("table_key", F.col("n_regionkey").alias("saved")), n.where("n_nationkey % 5 = 0").select("table_key", F.length("table_key").cast("long").alias("rows_read")))


# --- schema and scalars ----------------------------------------------------------------------------


@query("""WITH a AS (SELECT n_name AS name, 'long' AS t, true AS n FROM nation WHERE n_nationkey % 3 <> 0), b AS (SELECT n_name AS name, CASE WHEN n_nationkey % 4 = 0 THEN 'string' ELSE 'long' END AS t, n_nationkey % 5 <> 0 AS n FROM nation WHERE n_nationkey % 2 = 0)
SELECT * FROM (SELECT coalesce(a.name, b.name) AS name, CASE WHEN a.name IS NULL THEN 'added' WHEN b.name IS NULL THEN 'removed' WHEN a.t <> b.t THEN 'type_changed' WHEN a.n <> b.n THEN 'nullable_changed' END AS change FROM a FULL JOIN b ON a.name = b.name) WHERE change IS NOT NULL""")
def schema_diff_rows(spark, d):
    n = read(spark, d, "nation")
    a = n.where("n_nationkey % 3 <> 0").select(F.col("n_name").alias("name"), F.lit("long").alias("data_type"), F.lit(True).alias("nullable"))
    b = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 4 == 0, "string").otherwise("long").alias("data_type"), (F.col("n_nationkey") % 5 != 0).alias("nullable"))
    return schema.diff(a, b)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS DOUBLE) AS bad, props AS raw_item, epoch_us(ts) AS event_at FROM events")
def typed_projection(spark, d):
    e = read(spark, d, "events").select("event_id", "props", X.micros("ts").alias("event_at"))
    t = dynamic.typed(e, "props", {"k": "long", "missing": "double"})
    return t.select(F.col("event_id"), "k", F.col("missing").alias("bad"), "raw_item", "event_at")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id END AS n, CASE WHEN event_id % 2 = 0 THEN true ELSE false END AS flag FROM events")
def lenient_coercion(spark, d):
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).otherwise(F.concat(F.lit("x"), F.col("event_id").cast("string")))
    flag = F.when(F.col("event_id") % 2 == 0, "T").otherwise("0")
    return read(spark, d, "events").select("event_id", X.lenient(text, "long").alias("n"), X.lenient(flag, "boolean").alias("flag"))


@query("SELECT event_id, CASE WHEN event_id < 500 THEN -(abs(event_id - 500) * 1000000 + event_id % 10 * 100000 + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) ELSE abs(event_id - 500) * 1000000 + event_id % 10 * 100000 END AS us FROM events")
def epoch_parse(spark, d):
    i = F.col("event_id")
    text = F.concat(F.when(i < 500, "-").otherwise(""), F.abs(i - 500).cast("string"), F.lit("."), (i % 10).cast("string"), F.when(i % 3 == 0, "0000004").otherwise(""))
    return read(spark, d, "events").select("event_id", X.epoch_micros(text).alias("us"))


#: Interval texts of each form, `N` standing for a number, and their seconds as SQL; the last ones are no intervals.
_INTERVALS = [
    ("N days 04:05:06.5", "n * 86400 + 14706.5"), ("N mons", "n * 2592000"), ("-01:30:00", "-5400"), ("1 year N mons -2 days +00:00:N", "31557600 + n * 2592000 - 172800 + n"), ("  -N hours 3 mins  ", "n * -3600 + 180"),
    ("N.25 secs", "n + 0.25"), ("N fortnights", "NULL"), ("N", "NULL"), ("N monkey", "NULL"), ("01:N", "NULL"), ("N weeks", "NULL"), ("", "NULL"), ("N days 3", "NULL"), ("N 01:02:03", "NULL"), ("x:1:2", "NULL"),
]


@query(f"SELECT event_id, CASE event_id % {len(_INTERVALS)} " + " ".join(f"WHEN {k} THEN CAST({x} AS DOUBLE)" for k, (_, x) in enumerate(_INTERVALS)) + " END AS seconds FROM (SELECT event_id, event_id % 60 AS n FROM events)")
def interval_seconds(spark, d):
    form = F.element_at(F.array(*[F.lit(t) for t, _ in _INTERVALS]), (F.col("event_id") % len(_INTERVALS) + 1).cast("int"))
    text = F.replace(form, F.lit("N"), (F.col("event_id") % 60).cast("string"))
    return read(spark, d, "events").select("event_id", X.try_interval_seconds(text).alias("seconds"))


@query("SELECT event_id, base64(encode(event_type)) AS plain, base64(encode(event_type)) AS hexed FROM events")
def bytes_base64(spark, d):
    h = F.concat(F.lit("\\x"), F.lower(F.hex(F.col("event_type").cast("binary"))))
    return read(spark, d, "events").select("event_id", X.bytea_base64(F.col("event_type")).alias("plain"), X.bytea_base64(h).alias("hexed"))


@query("""SELECT event_id, '[' || event_id || ',null,' || event_id % 7 || ']' AS longs, CASE WHEN event_id % 5 = 0 THEN '["a\\"b",null,"NULL","x,y"]' ELSE '["' || event_type || '",null]' END AS strings,
  CASE WHEN event_id % 2 = 0 THEN '[true,false,null]' ELSE '{t,maybe}' END AS bools, CASE WHEN event_id % 3 = 0 THEN '[]' WHEN event_id % 3 = 1 THEN '{1,2' END AS odd FROM events""")
def array_to_json(spark, d):
    i = F.col("event_id")
    longs = F.concat(F.lit("{"), i.cast("string"), F.lit(",NULL,"), (i % 7).cast("string"), F.lit("}"))
    strings = F.when(i % 5 == 0, '{"a\\"b",null,"NULL",x\\,y}').otherwise(F.concat(F.lit("{"), "event_type", F.lit(",NULL}")))
    bools, odd = F.when(i % 2 == 0, "{t,f,NULL}").otherwise("{t,maybe}"), F.when(i % 3 == 0, "{}").when(i % 3 == 1, "{1,2")
    return read(spark, d, "events").select("event_id", X.array_to_json(longs).alias("longs"), X.array_to_json(strings, "string").alias("strings"), X.array_to_json(bools, "bool").alias("bools"), X.array_to_json(odd).alias("odd"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM events")
def rfc3339(spark, d):
    return read(spark, d, "events").select("event_id", X.rfc3339(F.col("ts")).alias("at"))


@query("SELECT o_orderpriority || '.' || o_orderkey AS name FROM orders WHERE (o_orderpriority || '.' || o_orderkey LIKE '1%.%7_' OR o_orderpriority || '.' || o_orderkey LIKE '%W.1%') AND o_orderpriority || '.' || o_orderkey NOT LIKE '%77'")
def table_selection_globs(spark, d):
    n = F.concat("o_orderpriority", F.lit("."), "o_orderkey")
    return schema.selected(read(spark, d, "orders").select(n.alias("name")), "name", ["1*.*7?", "*W.1*"], ["*77"])


@query("SELECT n_nationkey, regexp_replace(replace('public.' || n_name, '.', '__'), '[^A-Za-z0-9_]', '_', 'g') AS name FROM nation")
def destination_names(spark, d):
    return read(spark, d, "nation").select("n_nationkey", X.destination_name(F.concat(F.lit("public."), "n_name")).alias("name"))


@query("SELECT CAST(event_id AS VARCHAR) AS id FROM events")
def pk_identity(spark, d):
    return read(spark, d, "events").select(X.identity(F.col("event_id")).alias("id"))


_ERRORS = [
    ("Quota exceeded: too many DML jobs writing to a table", "backpressure"), ("quota exceeded for reads", "transient"), ("Destination deleted/expired during operation", "transient"),
    ("job failed: BIGQUERY_REASON=rateLimitExceeded", "backpressure"), ("bigquery_reason=backendError", "transient"), ("bigquery_reason=notFound x", "permanent"),
    ("bigquery_reason=strange", "transient"), ("connection reset", "transient"), (None, "transient"),
]
_quoted = lambda x: "NULL" if x is None else f"'{x}'"


def error_text(errors: list[str | None]):
    return F.element_at(F.array(*[F.lit(x) for x in errors]), (F.col("event_id") % len(errors) + 1).cast("int"))


@query(f"SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'permanent' ELSE [{', '.join(_quoted(c) for _, c in _ERRORS)}][event_id % {len(_ERRORS)} + 1] END AS class FROM events")
def retry_class(spark, d):
    kind = F.when(F.col("event_id") % 100 == 0, "lock").when(F.col("event_id") % 100 == 50, "policy")
    return read(spark, d, "events").select("event_id", X.retry_class(error_text([e for e, _ in _ERRORS]), kind).alias("class"))


_OLD = [None, "Incompatible schema change detected in t", "publication p is missing", "snapshot blocked for table(s): a", "connection already locked", "Failed to process CDC batch-load job 3",
        "merging staging BigQuery table s", "Quota exceeded: DML jobs writing to a table", "bad"]


@query(f"""WITH e AS (SELECT event_id, [{', '.join(map(_quoted, _OLD))}][event_id % {len(_OLD)} + 1] AS last_error, CASE WHEN event_id % 7 = 0 THEN 'truncate' END AS barrier_kind,
  ['{{"staging_schema":{{"a":1}}}}', '{{"staging_schema":null}}', '{{"steps":[]}}'][event_id % 3 + 1] AS payload FROM events)
SELECT event_id, CASE WHEN last_error IS NULL THEN NULL WHEN last_error ILIKE '%schema change detected%' THEN 'schema_blocked' WHEN last_error ILIKE '%publication%' THEN 'publication_blocked'
    WHEN last_error ILIKE '%snapshot blocked for table(s):%' THEN 'snapshot_blocked' WHEN last_error ILIKE '%already locked%' THEN 'lock_contention' ELSE 'last_run_failed' END AS reason,
  CASE WHEN last_error IS NULL THEN NULL WHEN last_error ILIKE '%quota exceeded%' AND last_error ILIKE '%dml jobs writing to a table%' THEN 'backpressure'
    WHEN last_error ILIKE '%failed to process CDC batch-load job%' OR last_error ILIKE '%merging staging BigQuery table%' OR last_error ILIKE '%BigQuery query returned errors%' THEN 'transient' ELSE 'permanent' END AS class,
  barrier_kind IS NULL AND coalesce(json_type(payload, '$.staging_schema'), 'NULL') <> 'NULL' AS eligible FROM e""")
def backfill_mappings(spark, d):
    payload = error_text(['{"staging_schema":{"a":1}}', '{"staging_schema":null}', '{"steps":[]}'])
    e, barrier = error_text(_OLD), F.when(F.col("event_id") % 7 == 0, "truncate")
    return read(spark, d, "events").select("event_id", X.old_error_reason(e).alias("reason"), X.old_retry_class(e).alias("class"), X.old_reducer_eligible(barrier, payload).alias("eligible"))


@query("SELECT event_id, event_id * 4294967296 + event_id % 1000 AS lsn FROM events")
def lsn_diff(spark, d):
    lsn = F.concat(F.hex("event_id"), F.lit("/"), F.hex(F.col("event_id") % 1000))
    return read(spark, d, "events").select("event_id", X.lsn_number(lsn).cast("long").alias("lsn"))


@query("SELECT event_id, substr(sha256('c1' || chr(0) || event_type || chr(0) || event_id), 1, 24) AS job_id FROM events")
def stable_job_id(spark, d):
    return read(spark, d, "events").select("event_id", X.stable_id(F.lit("c1"), F.col("event_type"), F.col("event_id")).alias("job_id"))


@query("SELECT event_id, 'postgres://' || event_type || ':***@db/' || event_id AS url FROM events")
def config_scrub(spark, d):
    url = F.concat(F.lit("postgres://"), "event_type", F.lit(":s3cret"), F.col("event_id").cast("string"), F.lit("@db/"), F.col("event_id").cast("string"))
    return read(spark, d, "events").select("event_id", X.scrub_url(url).alias("url"))


def _change_records(spark, d, cutoff_ms=None):
    """Creation times under either name, at either place, or missing; arrival times missing or not; old, new and key images."""
    i = F.col("event_id")
    image = F.concat(F.lit('{"id":{"S":"k'), i.cast("string"), F.lit('"}}'))
    removed = F.when(i % 4 == 0, "REMOVE").when(i % 4 == 1, "INSERT").otherwise("MODIFY")
    under = F.when(i % 3 == 0, F.concat(F.lit('"ApproximateCreationDateTime":'), i.cast("string"), F.lit(".5,"))).otherwise("")
    above = F.when(i % 3 == 1, F.concat(F.lit('"approximateCreationDateTime":'), i.cast("string"), F.lit(","))).otherwise("")
    name = F.when(i % 5 == 0, "Keys").when(i % 4 == 0, "OldImage").otherwise("NewImage")
    body = F.concat(F.lit('{"eventName":"'), removed, F.lit('",'), above, F.lit('"dynamodb":{'), under, F.lit('"'), name, F.lit('":'), image, F.lit("}}"))
    r = read(spark, d, "events").select(F.concat(F.lit("s"), (i % 7).cast("string")).alias("shard"), i.alias("position"), F.when(i % 2 == 0, i * 1000 + i % 13 * 700).alias("arrival_ms"), body.alias("body"))
    c = dynamic.change_records(r, now_s=5000.0, cutoff_ms=cutoff_ms)
    return c.select(F.substring_index("event_id", ":", -1).cast("long").alias("event_id"), "op", F.col("event_id").alias("key"), F.get_json_object(dynamic.decoded(F.col("item")), "$.id").alias("name"), "event_at_s", "deleted_at_s")


_CHANGES = """WITH r AS (SELECT event_id, event_id % 7 AS shard, CAST(CASE event_id % 3 WHEN 0 THEN event_id + 0.5 WHEN 1 THEN event_id ELSE 5000 END AS DOUBLE) AS event_at_s, event_id % 4 = 0 AS gone FROM events),
a AS (SELECT *, max(CASE WHEN coalesce(CASE WHEN event_id % 2 = 0 THEN event_id * 1000 + event_id % 13 * 700 END, event_at_s * 1000) > {0} THEN 1 ELSE 0 END) OVER (PARTITION BY shard ORDER BY event_id) AS late FROM r)
SELECT event_id, CASE WHEN gone THEN 'delete' ELSE 'upsert' END AS op, 's' || shard || ':' || event_id AS key, 'k' || event_id AS name, event_at_s, CASE WHEN gone THEN event_at_s END AS deleted_at_s FROM a WHERE late = 0"""


@query(_CHANGES.format(7_000_000))
def change_record_decode(spark, d):
    """One shot: each shard stops at its first record that arrived after the cutoff."""
    return _change_records(spark, d, cutoff_ms=7_000_000)


@query(_CHANGES.format("1e300"))
def change_record_decode_all(spark, d):
    return _change_records(spark, d)


@query(JOBS + "SELECT job_id, CASE WHEN stage = 'received' THEN CASE status WHEN 'running' THEN 'applying' WHEN 'succeeded' THEN 'applied' WHEN 'failed' THEN 'failed' ELSE stage END ELSE stage END AS stage FROM jobs")
def stage_normalisation(spark, d):
    return jobs(spark, d).select("job_id", ledger.stage_for(F.col("stage"), F.col("status")).alias("stage"))


@query(JOBS + f"""SELECT job_id, CASE WHEN due THEN 'pending' ELSE status END AS status, CASE WHEN due THEN 'received' ELSE stage END AS stage, CASE WHEN NOT due THEN last_error END AS last_error
FROM (SELECT *, coalesce(status = 'failed' AND retry_class IN ('backpressure','transient') AND updated_at + {BACKOFF} * 1000 <= {NOW}, false) AS due FROM jobs)""")
def requeued_jobs(spark, d):
    return ledger.requeued(jobs(spark, d), NOW, jitter=False).select("job_id", "status", "stage", "last_error")


@query(f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST({NOW} AS BIGINT) END AS by_flag, epoch_us(ts) AS by_time, CAST(NULL AS BIGINT) AS by_text, event_type AS kept_text FROM events")
def soft_delete_derivation(spark, d):
    us = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")
    e = read(spark, d, "events").withColumn("flag", F.when(F.col("event_id") % 3 == 0, True).when(F.col("event_id") % 3 == 1, False))
    e = e.select("event_id", X.deleted_at(F.col("flag"), "boolean", F.lit(NOW).cast("long")).alias("by_flag"), X.deleted_at(F.col("ts"), "timestamp_ntz", F.lit(NOW)).alias("t"),
                 X.deleted_at(F.col("event_type"), "string", F.lit(NOW)).alias("n"), X.deleted_at(F.col("event_type"), "string", F.lit(NOW), keep_text=True).alias("kept_text"))
    return e.select("event_id", "by_flag", us("t").alias("by_time"), us("n").alias("by_text"), "kept_text")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, '{\"a\":' || o_custkey || '}' AS extra, CAST(o_orderkey % 5 * 86400 AS DOUBLE) AS took FROM orders")
def cast_projection(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.struct(F.col("o_custkey").alias("a")).alias("extra"), F.concat((F.col("o_orderkey") % 5).cast("string"), F.lit(" days")).alias("took"))
    return o.select(*schema.cast_projection({"o_orderkey": "numeric", "o_custkey": "int64", "extra": "json", "took": "interval"}))


@query("""WITH a AS (SELECT n_nationkey AS id FROM nation WHERE n_nationkey % 2 = 0), b AS (SELECT n_nationkey AS id FROM nation WHERE n_nationkey % 3 = 0), c AS (SELECT n_nationkey AS id FROM nation WHERE n_nationkey % 5 <> 0)
SELECT id FROM (SELECT id FROM a UNION SELECT id FROM b) WHERE id IN (SELECT id FROM c)""")
def snapshot_scope_ids(spark, d):
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("id"))
    wanted = n.where("id % 2 = 0").unionByName(n.where("id % 3 = 0")).distinct()
    return wanted.join(n.where("id % 5 <> 0"), "id", "left_semi")


@query("""WITH k AS (SELECT user_id AS c, event_type AS entity, max(event_id) AS last_id FROM events GROUP BY 1, 2) SELECT c AS connection_id, CAST(count(*) AS BIGINT) AS entities, CAST(max(last_id) AS BIGINT) AS newest,
  CAST(sum(CASE WHEN last_id % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS incomplete FROM k GROUP BY 1""")
def state_assembly(spark, d):
    k = read(spark, d, "events").groupBy(F.col("user_id").alias("connection_id"), F.col("event_type").alias("entity_name")).agg(F.max("event_id").alias("i"))
    text = F.concat(F.lit('{"last":'), F.col("i").cast("string"), F.lit(',"snapshot_chunks":[{"complete":true},{"complete":'), (F.col("i") % 3 != 0).cast("string"), F.lit("}]}"))
    return stats.assembled(k.select("connection_id", "entity_name", text.alias("checkpoint_json"), F.col("i").alias("updated_at")))


@query("SELECT run_id, table_key, CASE WHEN run_id % 2 = 0 THEN 2 * n ELSE n END AS rows_read FROM (SELECT user_id AS run_id, event_type AS table_key, count(*) AS n FROM events GROUP BY 1, 2)")
def persist_run(spark, d):
    stored = run_table_stats(spark, d).select("run_id", "table_key", "rows_read")
    again = stored.where("run_id % 2 = 0").withColumn("rows_read", F.col("rows_read") * 2)
    return stats.persisted(stored, again)


@query("SELECT event_id, '{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\",\"gone\":null}' AS row FROM events")
def json_rows(spark, d):
    e = read(spark, d, "events").select("event_id", "event_type", F.lit(None).cast("string").alias("gone"))
    return encoded_rows(e).select(F.get_json_object("row", "$.event_id").cast("long").alias("event_id"), "row")


@query("SELECT event_id, '{\"b\":[\"' || event_id || '\",null],\"f\":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || ',\"id\":\"k' || event_id || '\",\"m\":{\"x\":[\"1\",\"2\"]},\"u\":null}' AS item FROM events")
def attribute_decode(spark, d):
    i = F.col("event_id").cast("string")
    item = F.concat(F.lit('{"id":{"S":"k'), i, F.lit('"},"b":{"L":[{"N":"'), i, F.lit('"},{"NULL":true}]},"f":{"BOOL":'), (F.col("event_id") % 2 == 0).cast("string"), F.lit('},"m":{"M":{"x":{"NS":["1","2"]}}},"u":{"?":1}}'))
    return read(spark, d, "events").select("event_id", dynamic.decoded(item).alias("item"))
