"""Queries of state changes, streams, sinks and source rules, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import control
from ..functions import scalars as X
from ..operators import changes, discovery, ledger, schema, snapshots, stats
from ..operators import transitions as T
from ..sources import dynamic, shards
from ..storage import VersionedTable, layout, strict
from ..streaming import decode, triggers
from .queries import BACKOFF, FRAGMENTS, JOBS, NOW, PROGRESS, WINDOW, _QUEUE, fragments, jobs, log, queue, sequences
from .registry import query, read


def scratch(spark, kind: str) -> str:
    """A new folder in the warehouse, which all executors share."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidelog-queries/{kind}-{uuid.uuid4().hex}"


def number(column: str = "job_id"):
    return F.substr(column, F.lit(2)).cast("long")


# --- ledger transitions -------------------------------------------------------------------------------

_STATE = "connection_id, job_id, table_key, status, stage, attempt_count, retry_class, last_error, updated_at"
_COLUMNS = _STATE.split(", ")


@query(JOBS + f""", incoming AS (SELECT connection_id, 'j' || lpad(CAST(CAST(substr(job_id, 2) AS BIGINT) + 50 AS VARCHAR), 10, '0') AS job_id, 'new' AS table_key, 'pending' AS status, 'received' AS stage, 0 AS attempt_count, NULL AS retry_class, 'new' AS last_error, {NOW + 5} AS updated_at
  FROM jobs WHERE CAST(substr(job_id, 2) AS BIGINT) % 2 = 1)
SELECT coalesce(o.connection_id, n.connection_id) AS connection_id, coalesce(o.job_id, n.job_id) AS job_id, CAST(coalesce(o.attempt_count, n.attempt_count) AS INTEGER) AS attempt_count,
  {", ".join(f"CASE WHEN o.job_id IS NULL OR (o.status = 'failed' AND n.job_id IS NOT NULL) THEN n.{c} ELSE o.{c} END AS {c}" for c in ("table_key", "status", "stage", "retry_class", "updated_at"))},
  CASE WHEN o.job_id IS NULL THEN n.last_error WHEN o.status = 'failed' AND n.job_id IS NOT NULL THEN NULL ELSE o.last_error END AS last_error
FROM jobs o FULL JOIN incoming n ON o.job_id = n.job_id""")
def enqueue_revives_failed(spark, d):
    j = jobs(spark, d)
    i = number()
    new = j.where(i % 2 == 1).withColumns({
        "job_id": F.concat(F.lit("j"), F.lpad((i + 50).cast("string"), 10, "0")), "table_key": F.lit("new"), "status": F.lit("pending"), "stage": F.lit("received"), "attempt_count": F.lit(0),
        "retry_class": F.lit(None).cast("string"), "last_error": F.lit("new"), "updated_at": F.lit(NOW + 5).cast("long"),
    })
    return T.enqueued(j, new).select(*_COLUMNS)


def _updated(chosen: str, **values: str) -> str:
    """SQL of the job states, with values for those that are chosen."""
    each = [f"CASE WHEN {chosen} THEN {values[c]} ELSE {c} END AS {c}" if c in values else c for c in _COLUMNS]
    return f"SELECT {', '.join(each)} FROM jobs"


_FREE = f"status = 'pending' AND (stage = 'received' OR (stage = 'staged' AND updated_at < {NOW - 90000}))"


@query(JOBS + _updated(f"job_id IN (SELECT job_id FROM jobs WHERE {_FREE} QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY first_sequence, created_at, job_id) = 1)", stage="'staged'", attempt_count="CAST(attempt_count + 1 AS INTEGER)", last_error="NULL", updated_at=str(NOW)))
def staging_claimed_jobs(spark, d):
    return T.staging_claimed(jobs(spark, d), NOW, NOW - 90_000).select(*_COLUMNS)


@query(_QUEUE + WINDOW + f""", first AS (SELECT l.connection_id, l.job_id FROM queue l WHERE l.job_id IN (SELECT head_id FROM placed WHERE ready) QUALIFY row_number() OVER (PARTITION BY l.connection_id ORDER BY l.first_sequence, l.created_at, l.job_id) = 1),
taken AS (SELECT p.job_id FROM placed p JOIN first ON p.head_id = first.job_id WHERE p.place <= 5)
SELECT connection_id, job_id, CASE WHEN job_id IN (SELECT job_id FROM taken) THEN 'running' ELSE status END AS status, CASE WHEN job_id IN (SELECT job_id FROM taken) THEN 'applying' ELSE stage END AS stage,
  CASE WHEN job_id IN (SELECT job_id FROM taken) THEN {NOW} ELSE updated_at END AS updated_at FROM queue""")
def window_claimed_jobs(spark, d):
    q = queue(spark, d).withColumn("last_error", F.lit("x"))
    return T.window_claimed(q, NOW, NOW - 1_000, 5, 2_000).select("connection_id", "job_id", "status", "stage", "updated_at")


_HELD = "CAST(substr(job_id, 2) AS BIGINT) % 3 = 0"


@query(JOBS + _updated(f"{_HELD} AND (status = 'running' OR (status = 'pending' AND stage = 'staged'))", updated_at=str(NOW + 9)))
def heartbeat_jobs(spark, d):
    j = jobs(spark, d)
    return T.heartbeat(j, j.where(number() % 3 == 0).select("connection_id", "job_id"), NOW + 9).select(*_COLUMNS)


@query(JOBS + _updated(f"{_HELD} AND status = 'running'", status="'succeeded'", stage="'applied'", retry_class="NULL", last_error="NULL", updated_at=str(NOW + 9)))
def succeeded_jobs(spark, d):
    j = jobs(spark, d)
    return T.succeeded(j, j.where((number() % 3 == 0) & (F.col("status") == "running")).select("connection_id", "job_id"), NOW + 9).select(*_COLUMNS)


@query(JOBS + _updated(f"{_HELD} AND status = 'running'", status="'failed'", stage="'failed'", retry_class="'transient'", last_error="'lost ' || job_id", updated_at=str(NOW + 9)))
def failed_jobs(spark, d):
    j = jobs(spark, d)
    e = j.where((number() % 3 == 0) & (F.col("status") == "running")).select("connection_id", "job_id", F.concat(F.lit("lost "), "job_id").alias("error"), F.lit("transient").alias("class"))
    return T.failed(j, e, NOW + 9).select(*_COLUMNS)


@query(JOBS + _updated(f"{_HELD} AND status = 'running'", status="'pending'", stage="'blocked'", retry_class="NULL", last_error=f"'{ledger.HANDOFF} of ' || table_key", updated_at=str(NOW + 9)))
def handed_off_jobs(spark, d):
    j = jobs(spark, d)
    return T.handed_off(j, j.where(number() % 3 == 0), "table_key", NOW + 9).select(*_COLUMNS)


@query(JOBS + _updated(f"status = 'pending' AND stage = 'blocked' AND last_error LIKE '{ledger.HANDOFF}%' AND table_key <> 'click'", stage="'loaded'", last_error="NULL", updated_at=str(NOW + 9)))
def handoff_released_jobs(spark, d):
    c = spark.createDataFrame([("click", [(True,), (False,)]), ("view", [(True,)])], "table_key string, chunks array<struct<complete boolean>>")
    return T.handoff_released(jobs(spark, d), c, NOW + 9).select(*_COLUMNS)


@query(JOBS + """, h AS (SELECT connection_id, table_key, job_id, first_sequence FROM jobs WHERE status IN ('pending', 'running', 'failed') QUALIFY row_number() OVER (PARTITION BY connection_id, table_key ORDER BY first_sequence, created_at, job_id) = 1)
SELECT connection_id, table_key, CASE WHEN table_key = 'view' THEN 'old' ELSE job_id END AS job_id, first_sequence FROM h""")
def refreshed_heads(spark, d):
    j = jobs(spark, d)
    old = ledger.heads(j).withColumn("job_id", F.lit("old"))
    return T.refreshed_heads(old, j, j.where("table_key <> 'view'").select("connection_id", "table_key"))


_KEYS = "WITH old AS (SELECT event_id % 500 AS connection_id, event_type AS entity_name, max(event_id) AS checkpoint, min(props) AS note FROM events WHERE event_id % 3 <> 0 GROUP BY 1, 2), new AS (SELECT event_id % 700 AS connection_id, event_type AS entity_name, min(event_id) AS checkpoint FROM events WHERE event_id % 3 = 0 GROUP BY 1, 2) "


@query(_KEYS + "SELECT coalesce(o.connection_id, n.connection_id) AS connection_id, coalesce(o.entity_name, n.entity_name) AS entity_name, coalesce(n.checkpoint, o.checkpoint) AS checkpoint, o.note FROM old o FULL JOIN new n ON o.connection_id = n.connection_id AND o.entity_name = n.entity_name")
def saved_checkpoints(spark, d):
    e = read(spark, d, "events")
    old = e.where("event_id % 3 <> 0").groupBy((F.col("event_id") % 500).alias("connection_id"), F.col("event_type").alias("entity_name")).agg(F.max("event_id").alias("checkpoint"), F.min("props").alias("note"))
    new = e.where("event_id % 3 = 0").groupBy((F.col("event_id") % 700).alias("connection_id"), F.col("event_type").alias("entity_name")).agg(F.min("event_id").alias("checkpoint"))
    return T.saved(old, new, ["connection_id", "entity_name"], ["checkpoint"])


@query("WITH r AS (SELECT 'c' || n_regionkey AS connection_id, n_name AS source_table, CASE WHEN n_nationkey % 3 = 0 THEN 99 ELSE n_nationkey END AS requested_at FROM nation WHERE n_nationkey % 2 = 0 OR n_nationkey % 3 = 0) SELECT source_table, CAST(requested_at AS BIGINT) AS requested_at FROM r WHERE connection_id = 'c1' AND source_table NOT LIKE 'C%'")
def resync_requests(spark, d):
    n = read(spark, d, "nation").select(F.concat(F.lit("c"), "n_regionkey").alias("connection_id"), F.col("n_name").alias("source_table"), F.col("n_nationkey").cast("long").alias("requested_at"))
    asked = T.resync_requested(n.where("requested_at % 2 = 0"), n.where("requested_at % 3 = 0"), 99)
    return T.resync_pending(T.resync_cleared(asked, n.where("source_table LIKE 'C%'").select("connection_id", "source_table")), "c1").select("source_table", "requested_at")


# --- snapshots beside the log -------------------------------------------------------------------------

_SNAPSHOT = """s AS (SELECT user_id, min(event_id) AS event_id, 50 + user_id % 3 * 400 AS snapshot_sequence FROM events WHERE user_id % 4 <> 0 GROUP BY user_id)"""


@query(f"""WITH log AS (SELECT event_id, user_id, event_id // 10 AS sequence, event_type = 'error' AS gone FROM events WHERE event_id % 1009 <> 13), cut AS (SELECT max(event_id) AS at, max(event_id // 10) AS seq FROM events WHERE event_id % 1009 = 13 AND event_id < 2000), {_SNAPSHOT},
base AS (SELECT * FROM s, cut WHERE cut.at IS NULL OR snapshot_sequence >= seq), last AS (SELECT user_id, event_id, sequence, gone FROM log, cut WHERE cut.at IS NULL OR event_id > cut.at QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
newer AS (SELECT l.* FROM last l LEFT JOIN base b ON l.user_id = b.user_id WHERE b.user_id IS NULL OR l.sequence > b.snapshot_sequence)
SELECT user_id, event_id, CASE WHEN gone THEN {NOW} END AS deleted_at FROM newer UNION ALL SELECT user_id, event_id, NULL FROM base WHERE user_id NOT IN (SELECT user_id FROM newer)""")
def snapshot_log_overlap(spark, d):
    e = read(spark, d, "events")
    s = e.where("user_id % 4 <> 0").groupBy("user_id").agg(F.min("event_id").alias("event_id")).withColumn("snapshot_sequence", 50 + F.col("user_id") % 3 * 400)
    rows = log(spark, d).withColumn("op", F.when((F.col("event_id") % 1009 == 13) & (F.col("event_id") < 2000), "truncate").otherwise(F.col("op"))).where("op = 'truncate' OR event_id % 1009 <> 13")
    return snapshots.overlapped(s, rows, "user_id", ["user_id", "event_id"], F.lit(NOW)).select("user_id", "event_id", "deleted_at")


@query(JOBS + "SELECT job_id, CASE table_key WHEN 'click' THEN 'snapshotting' WHEN 'view' THEN 'blocked' ELSE 'ready' END AS gate FROM jobs")
def apply_readiness(spark, d):
    c = spark.createDataFrame([("click", "running", [(True,), (False,)]), ("view", "blocked", [(False,)]), ("error", "running", [(True,)])], "table_key string, status string, chunks array<struct<complete boolean>>")
    return snapshots.readiness(jobs(spark, d), c).select("job_id", "gate")


@query("SELECT n_name AS table_key, row_number() OVER (PARTITION BY n_name ORDER BY n_regionkey, k) AS turn, k AS chunk FROM nation, range(4) t(k) WHERE k <= n_nationkey % 4")
def snapshot_turns(spark, d):
    n = read(spark, d, "nation")
    tasks = n.select(F.col("n_name").alias("table_key"), F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n_nationkey") % 4).cast("long"))).alias("chunk"))
    return snapshots.round_robin(tasks).select("table_key", "turn", "chunk")


_FLAGS = "SELECT n_name AS table_key, n_nationkey % 5 <> 4 AS included, n_nationkey % 2 = 0 AS in_progress, n_nationkey % 3 = 0 AS resync, n_nationkey % 7 = 1 AS new FROM nation"


@query(f"WITH f AS ({_FLAGS}) SELECT table_key, CASE WHEN resync OR in_progress THEN 'upsert' ELSE 'append' END AS mode, NOT (resync OR in_progress) AS truncate_first FROM f WHERE included AND (in_progress OR resync OR new)")
def snapshot_scope(spark, d):
    k = F.col("n_nationkey")
    flags = read(spark, d, "nation").select(F.col("n_name").alias("table_key"), (k % 5 != 4).alias("included"), (k % 2 == 0).alias("in_progress"), (k % 3 == 0).alias("resync"), (k % 7 == 1).alias("new"))
    return snapshots.scope(flags, full=False, has_position=True, keep_backlog=False)


# --- the log as messages ------------------------------------------------------------------------------

_MESSAGES = """WITH m AS (SELECT event_id AS i, event_id // 10 AS tx, event_id % 10 AS k, event_id // 10 % 4 AS rel, user_id FROM events),
changes AS (SELECT m.*, CASE k % 4 WHEN 1 THEN 'insert' WHEN 2 THEN 'update' WHEN 3 THEN 'delete' ELSE 'truncate' END AS op FROM m WHERE k BETWEEN 1 AND 7 AND NOT (k = 5 AND tx % 6 = 0) AND tx % 5 <> 4 AND (SELECT max(event_id) FROM events) >= tx * 10 + 9),
each AS (SELECT i, tx, op, unnest(CASE WHEN op = 'truncate' THEN [0, 1, 3] ELSE [rel] END) AS rel FROM changes), kept AS (SELECT i, tx, op, rel, 't' || rel AS tbl FROM each WHERE rel <> 3) """


def messages(spark, d) -> DataFrame:
    """Ten messages a transaction: begin, changes, now and then a relation in the middle, commit. Every fifth transaction never commits."""
    i, tx, k = F.col("event_id"), F.expr("event_id div 10"), F.col("event_id") % 10
    kind = F.when(k == 0, "begin").when((k == 9) & (tx % 5 != 4), "commit").when((k == 5) & (tx % 6 == 0), "relation").when(k >= 8, "keepalive")
    kind = kind.when(k % 4 == 1, "insert").when(k % 4 == 2, "update").when(k % 4 == 3, "delete").otherwise("truncate")
    rel = tx % 4
    extra = F.when(tx % 12 == 0, F.array(F.struct(F.lit("extra").alias("name"), F.when(tx % 24 == 0, "text").otherwise("int8").alias("type")))).otherwise(F.array().cast("array<struct<name:string,type:string>>"))
    columns = F.concat(F.array(F.struct(F.lit("id").alias("name"), F.lit("int8").alias("type"))), extra)
    return read(spark, d, "events").select(
        i.alias("position"), tx.alias("tx"), kind.alias("kind"), F.when(k.isin(0, 9), F.concat(F.lit("0/"), F.hex(i))).alias("commit_lsn"), F.when(~k.isin(0, 9), rel).alias("rel_id"),
        F.when(kind == "truncate", F.array(*[F.lit(x).cast("long") for x in (0, 1, 3)])).alias("rel_ids"), F.when(kind == "relation", columns).alias("columns"),
        F.when(kind.isin("update", "delete"), F.to_json(F.struct("user_id"))).alias("before"), F.when(kind.isin("insert", "update"), F.to_json(F.struct("user_id"))).alias("after"),
    )


def _tables(spark):
    return spark.createDataFrame([(k, f"t{k}") for k in range(3)], "rel_id long, table string")


@query(_MESSAGES + """, v AS (SELECT tx * 10 + 5 AS pos, tx % 4 AS rel, CASE WHEN tx % 12 = 0 THEN 2 ELSE 1 END AS n FROM (SELECT DISTINCT tx FROM m WHERE k = 5) WHERE tx % 6 = 0)
SELECT k.tx, '0/' || to_hex(k.tx * 10 + 9) AS commit_lsn, row_number() OVER (PARTITION BY k.tx ORDER BY k.i, tbl) - 1 AS tx_ordinal, op, tbl, (SELECT arg_max(n, v.pos) FROM v WHERE v.rel = k.rel AND v.pos < k.i) AS n_columns FROM kept k""")
def log_decode(spark, d):
    c = decode.committed_changes(messages(spark, d), _tables(spark), most_pending=1000)
    return c.select("tx", "commit_lsn", "tx_ordinal", "op", F.col("table").alias("tbl"), F.when(F.col("columns").isNotNull(), F.size("columns")).cast("long").alias("n_columns"))


@query(_MESSAGES + """, v AS (SELECT tx * 10 + 5 AS position, tx % 4 AS rel_id, tx, CASE WHEN tx % 24 = 0 THEN 'text' WHEN tx % 12 = 0 THEN 'int8' END AS extra FROM (SELECT DISTINCT tx FROM m WHERE k = 5) WHERE tx % 6 = 0),
p AS (SELECT *, lag(position) OVER w AS last, lag(extra) OVER w AS old FROM v WINDOW w AS (PARTITION BY rel_id ORDER BY position))
SELECT rel_id, position, 'extra' AS name, CASE WHEN old IS NULL THEN 'added' WHEN extra IS NULL THEN 'removed' ELSE 'type_changed' END AS change FROM p WHERE last IS NOT NULL AND old IS DISTINCT FROM extra""")
def relation_changes(spark, d):
    return decode.relation_changes(messages(spark, d))


@query(_MESSAGES + ", c AS (SELECT tx, dense_rank() OVER (ORDER BY tx) - 1 + 100 AS sequence FROM (SELECT DISTINCT tx FROM kept)) SELECT sequence, tbl, count(*) AS events FROM kept JOIN c USING (tx) GROUP BY 1, 2")
def decoded_commit_fragments(spark, d):
    c = decode.numbered_commits(decode.committed_changes(messages(spark, d), _tables(spark)), 100)
    return changes.split_by_table(c).select("sequence", F.col("table").alias("tbl"), "events")


@query("SELECT event_id // 10 AS sequence, t AS tbl, count(*) AS events, min(event_id % 10) AS first_ordinal FROM (SELECT event_id, unnest(CASE WHEN event_id % 10 = 4 THEN ['a', 'b', 'c'] ELSE [event_type] END) AS t FROM events) GROUP BY 1, 2")
def truncate_fan_out(spark, d):
    l = log(spark, d).withColumn("op", F.when(F.col("tx_ordinal") == 4, "truncate").otherwise(F.col("op"))).withColumn("table", F.col("event_type")).withColumn("tables", F.array(*[F.lit(x) for x in "abc"]))  # noqa: E741
    return changes.split_by_table(l).withColumnRenamed("table", "tbl")


@query(f"""WITH l AS (SELECT event_id, event_type, event_id % 997 = 5 AS cut, event_type = 'error' AS gone FROM events), c AS (SELECT event_type, max(event_id) AS at_id FROM l WHERE cut GROUP BY 1)
SELECT l.event_id, CASE WHEN gone THEN {NOW} END AS deleted_at FROM l LEFT JOIN c USING (event_type) WHERE NOT cut AND (at_id IS NULL OR l.event_id > at_id)""")
def every_change_kept(spark, d):
    l = log(spark, d).withColumn("op", F.when(F.col("event_id") % 997 == 5, "truncate").otherwise(F.col("op"))).withColumn("table", F.col("event_type"))  # noqa: E741
    return changes.uncompacted(l, F.lit(NOW), True).select("event_id", "deleted_at")


@query("SELECT user_id, event_id, event_type = 'error' AS gone FROM events WHERE event_type <> 'error' OR event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def deletes_need_an_old_row(spark, d):
    l = log(spark, d).withColumn("has_before", F.col("event_id") % 2 == 0)  # noqa: E741
    return changes.compact(l, ["user_id"], True, before="has_before", one_table="events").select("user_id", "event_id", (F.col("op") == "delete").alias("gone"))


@query("SELECT event_id, 1000 + event_id // 10 AS _sequence, '0/' || to_hex(event_id // 10) AS _commit_lsn, event_id % 10 AS _tx_ordinal FROM events")
def staging_by_commit(spark, d):
    l = log(spark, d).withColumn("commit_lsn", F.concat(F.lit("0/"), F.hex("sequence"))).drop("sequence")  # noqa: E741
    commits = log(spark, d).select(F.concat(F.lit("0/"), F.hex("sequence")).alias("commit_lsn"), (F.col("sequence") + 1000).alias("sequence")).distinct()
    return changes.staging(l, commits=commits).select("event_id", "_sequence", "_commit_lsn", "_tx_ordinal")


# --- triggers and acknowledgement ---------------------------------------------------------------------


@query("""WITH p AS (SELECT user_id AS table_key, count(*) AS events, min(event_id) AS first_buffered_at, min(event_id // 10) AS first_sequence, user_id % 7 = 0 AS active FROM events GROUP BY 1)
SELECT table_key, events FROM p WHERE (events >= 12 OR 3000 - first_buffered_at >= 2000) AND NOT active ORDER BY first_sequence, table_key LIMIT 11""")
def ready_tables(spark, d):
    p = read(spark, d, "events").groupBy(F.col("user_id").alias("table_key")).agg(F.count("*").alias("events"), F.min("event_id").alias("first_buffered_at"), F.min(F.expr("event_id div 10")).alias("first_sequence"))
    return triggers.ready_tables(p.withColumn("active", F.col("table_key") % 7 == 0), 3000, 12, 2000, 16, 5).select("table_key", "events")


@query("""WITH RECURSIVE e AS (SELECT event_type AS table_key, event_id AS position, event_id * 3 AS at_ms, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events),
ends AS (SELECT a.table_key, a.n, min(least(a.n + 40, coalesce((SELECT min(b.n) FROM e b WHERE b.table_key = a.table_key AND b.at_ms >= a.at_ms + 500), a.n + 40))) AS nxt FROM e a GROUP BY 1, 2),
starts(table_key, n, flush) AS (SELECT table_key, 1, 0 FROM e WHERE n = 1 UNION ALL SELECT s.table_key, ends.nxt, s.flush + 1 FROM starts s JOIN ends ON ends.table_key = s.table_key AND ends.n = s.n WHERE EXISTS (SELECT 1 FROM e WHERE e.table_key = s.table_key AND e.n = ends.nxt))
SELECT e.table_key, e.position, e.at_ms, CAST(max(s.flush) AS BIGINT) AS flush FROM e JOIN starts s ON s.table_key = e.table_key AND s.n <= e.n GROUP BY 1, 2, 3""")
def flush_groups(spark, d):
    e = read(spark, d, "events").select(F.col("event_type").alias("table_key"), F.col("event_id").alias("position"), (F.col("event_id") * 3).alias("at_ms"))
    return triggers.flush_groups(e, 40, 500)


@query(f"SELECT event_id, CASE WHEN {' AND '.join(f'event_id % {n} <> 0' for n in range(2, 11))} AND event_id > 3000 THEN event_id ELSE 3000 END AS lsn, event_id % 2 = 0 AND event_id % 23 >= 10 AS stops FROM events")
def keepalive_feedback(spark, d):
    i = F.col("event_id")
    idle = {c: i % n != 0 for n, c in enumerate(triggers.IDLE, 2)}
    return read(spark, d, "events").select("event_id", triggers.feedback(i, F.lit(3000).cast("long"), idle).alias("lsn"), triggers.stops(i % 2 == 1, i % 23).alias("stops"))


@query(FRAGMENTS + "SELECT fragment_id, status = 'succeeded' AS at_target, status IN ('succeeded', 'pending') AS when_durable FROM fragments")
def ack_boundary(spark, d):
    f = fragments(spark, d).withColumns({"applied": F.col("status") == "succeeded", "landed": F.col("status").isin("succeeded", "pending")})
    f = triggers.acknowledged(f, "target_apply").withColumnRenamed("acked", "at_target")
    return triggers.acknowledged(f, "durable_enqueue", 100_000).select("fragment_id", "at_target", F.col("acked").alias("when_durable"))


@query(PROGRESS + """, w AS (SELECT *, max(CASE WHEN sequence <> 3 + rn - 1 OR succeeded_fragments < greatest(expected_fragments, 1) THEN 1 ELSE 0 END) OVER (ORDER BY sequence) AS stop FROM (SELECT *, row_number() OVER (ORDER BY sequence) AS rn FROM progress WHERE sequence >= 3 AND sequence < 1003))
SELECT connection_id, 3 + count(*) AS next_sequence, arg_max(commit_lsn, sequence) AS commit_lsn FROM w WHERE stop = 0 GROUP BY 1 HAVING 3 + count(*) >= 8""")
def advanced_frontier(spark, d):
    of = lambda n: spark.createDataFrame([("c1", n)], "connection_id string, next_sequence long")
    return triggers.advanced_frontier(ledger.fragment_progress(sequences(spark, d), fragments(spark, d)), of(8), of(3), 1000)


# --- shards, exports, discovery -----------------------------------------------------------------------

_RECORDS = "WITH r AS (SELECT 's' || event_id % 7 AS shard, CAST(event_id AS HUGEINT) * 1000000000000000000 AS n, event_id * 10 AS arrival_ms, event_id FROM events), k AS (SELECT 's' || t AS shard, CASE WHEN t % 2 = 0 THEN CAST(900 + t AS HUGEINT) * 1000000000000000000 END AS after FROM range(7) x(t)) "
_UNREAD = _RECORDS + ", u AS (SELECT r.* FROM r JOIN k USING (shard) WHERE CASE WHEN after IS NOT NULL THEN n > after ELSE arrival_ms >= 20000 END QUALIFY row_number() OVER (PARTITION BY shard ORDER BY n) <= 100) "


def _stream(spark, d):
    """Records with long sequence numbers, checkpoints of every other shard, and where each goes on."""
    zeros = F.when(F.col("event_id") == 0, "").otherwise("000000000000000000")
    r = read(spark, d, "events").select(F.concat(F.lit("s"), F.col("event_id") % 7).alias("shard"), F.concat(F.col("event_id").cast("string"), zeros).alias("sequence"), (F.col("event_id") * 10).alias("arrival_ms"), "event_id")
    c = spark.createDataFrame([(f"s{k}", f"{900 + k}000000000000000000") for k in range(0, 7, 2)], "shard string, sequence string")
    points = shards.resume_points(spark.createDataFrame([(f"s{k}",) for k in range(7)], "shard string"), c, 20_000, "arn", "arn")
    return r, c, points


@query(_UNREAD + "SELECT shard, event_id FROM u")
def shard_follow(spark, d):
    r, _, points = _stream(spark, d)
    return shards.unread(r, points, 100).select("shard", "event_id")


@query(_UNREAD + "SELECT k.shard, CAST(coalesce(max(u.n), any_value(k.after)) AS VARCHAR) AS sequence FROM k LEFT JOIN u USING (shard) GROUP BY 1 HAVING count(u.n) > 0 OR any_value(k.after) IS NOT NULL")
def shard_checkpoints(spark, d):
    r, c, points = _stream(spark, d)
    return shards.advanced(c, shards.unread(r, points, 100))


@query("SELECT 'k' || event_id AS id, CAST(event_id AS VARCHAR) AS n FROM events")
def export_scan(spark, d):
    """Lines of a gzipped export, written and read again."""
    i = F.col("event_id").cast("string")
    path = scratch(spark, "export")
    line = F.concat(F.lit('{"Item":{"id":{"S":"k'), i, F.lit('"},"n":{"N":"'), i, F.lit('"}}}'))
    read(spark, d, "events").select(line.alias("value")).write.option("compression", "gzip").text(path)
    item = F.col("item")
    return dynamic.read_export(spark, path).select(dynamic.flat_attribute(item, "id").alias("id"), dynamic.flat_attribute(item, "n").alias("n"))


@query("SELECT 'main.' || n_name AS name FROM nation WHERE n_regionkey <> 2 AND n_nationkey % 3 <> 0")
def table_discovery(spark, d):
    k = F.col("n_nationkey")
    schemas = F.when(F.col("n_regionkey") == 2, "pg_catalog").otherwise("main")
    t = read(spark, d, "nation").select(schemas.alias("table_schema"), F.col("n_name").alias("table_name"), F.when(k % 3 == 0, "VIEW").otherwise("BASE TABLE").alias("table_type"))
    return discovery.base_tables(t)


@query("""SELECT n_name AS name, CASE WHEN n_nationkey % 4 = 0 THEN 'own' WHEN n_nationkey % 4 = 1 THEN 'id' END AS primary_key, CASE WHEN n_nationkey % 2 = 0 THEN 'changed' ELSE 'updated_at' END AS updated_at_column, n_nationkey % 3 = 0 AS soft_delete,
  CASE WHEN n_nationkey % 7 = 0 THEN 'table is missing' WHEN n_nationkey % 4 = 2 THEN 'composite primary key' WHEN n_nationkey % 4 = 3 THEN 'no primary key' END AS problem FROM nation""")
def table_defaults(spark, d):
    k, n = F.col("n_nationkey"), read(spark, d, "nation")
    none = F.lit(None).cast("string")
    configured = n.select(F.col("n_name").alias("name"), F.when(k % 4 == 0, "own").alias("primary_key"), F.when(k % 2 == 0, "changed").alias("updated_at_column"), F.when(k % 3 == 0, True).alias("soft_delete"), none.alias("soft_delete_column"), none.alias("where_clause"))
    keys = n.where("n_nationkey % 4 in (0, 1, 2)").select(F.col("n_name").alias("name"), F.explode(F.when(k % 4 == 2, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("id")))).alias("column"))
    keys = keys.withColumn("position", F.when(F.col("column") == "b", 2).otherwise(1))
    found = n.where("n_nationkey % 7 <> 0").select(F.col("n_name").alias("name"))
    return discovery.resolved(configured, {"updated_at_column": "updated_at"}, found, keys).select("name", "primary_key", "updated_at_column", "soft_delete", "problem")


@query("SELECT table_name AS name, column_name AS \"column\", CAST(ordinal_position AS INTEGER) AS position, column_name LIKE '%key' AND ordinal_position = 1 AS is_key FROM information_schema.columns WHERE table_name IN ('orders', 'customer', 'nation') AND table_schema = 'main'")
def schema_discovery(spark, d):
    names = ("orders", "customer", "nation")
    rows = [discovery.schema_rows(read(spark, d, n), n) for n in names]
    keys = spark.createDataFrame([("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey")], "name string, column string")
    return discovery.table_columns(rows[0].unionByName(rows[1]).unionByName(rows[2]), keys).select("name", "column", "position", "is_key")


@query("""SELECT n_name AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'not in the publication' WHEN n_nationkey % 5 = 1 THEN 'row filter differs' WHEN n_nationkey % 5 = 2 THEN 'unexpected row filter' ELSE 'row filter is missing' END AS problem
FROM nation WHERE n_nationkey % 5 <> 4""")
def publication_problems(spark, d):
    k, n = F.col("n_nationkey") % 5, read(spark, d, "nation")
    configured = n.select(F.col("n_name").alias("name"), F.when(k == 1, "a = 'X'").when(k == 3, "a = 1").when(k == 4, "( Tenant_ID = 'X y' )").alias("where_clause"))
    published = n.where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("name"), F.when(k == 1, "a = 'x'").when(k == 2, "b").when(k == 4, "tenant_id='X y'").alias("row_filter"))
    return discovery.publication_problems(configured, published)


@query("SELECT n_name AS name, '((a' || n_nationkey || '=''X Y''))' AS spelled, 'a' || n_nationkey || '=''X Y''' AS normal FROM nation")
def filter_normalisation(spark, d):
    spelled = F.concat(F.lit("((a"), "n_nationkey", F.lit("='X Y'))"))
    return read(spark, d, "nation").select(F.col("n_name").alias("name"), spelled.alias("spelled"), discovery.normal_filter(F.concat(F.lit(" ( "), F.replace(spelled, F.lit("="), F.lit("\n = ")), F.lit(")"))).alias("normal"))


# --- sinks --------------------------------------------------------------------------------------------


def _sink(spark, d, **options):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    return VersionedTable(spark, scratch(spark, "table"), "o_orderkey", buckets=4, **options), o


@query("WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice AS price FROM orders) SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN price + 1 ELSE price END AS price, CASE WHEN o_orderkey % 5 = 0 THEN 'new' END AS extra FROM s WHERE o_orderkey % 2 = 0 OR o_orderkey % 5 = 0")
def table_batches(spark, d):
    """Appended rows, an upsert that brings a column, and the same upsert again."""
    t, o = _sink(spark, d)
    t.append(o.where("o_orderkey % 2 = 0"))
    new = o.where("o_orderkey % 5 = 0").withColumns({"price": F.col("price") + 1, "extra": F.lit("new")})
    for _ in range(2):
        t.write_batch(new, name="batch-1")
    return t.read()


@query("SELECT o_orderkey, o_custkey, o_totalprice AS price FROM orders WHERE o_orderkey % 7 = 0")
def table_truncated(spark, d):
    """A truncate before a batch is part of its version."""
    t, o = _sink(spark, d)
    t.append(o)
    t.write_batch(o.where("o_orderkey % 7 = 0"), truncate_first=True)
    return t.read()


@query("SELECT o_orderkey, o_custkey, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0")
def table_version(spark, d):
    """An earlier version is read as it was, after a truncate too."""
    t, o = _sink(spark, d)
    first = t.append(o.where("o_orderkey % 2 = 0"))
    t.append(o.where("o_orderkey % 2 = 1"))
    t.truncate()
    return t.read(first)


@query("SELECT column_name AS name FROM information_schema.columns WHERE table_name = 'orders' AND table_schema = 'main' UNION ALL SELECT * FROM (VALUES ('synced_at'), ('deleted_at'), ('extra'))")
def table_ensured(spark, d):
    """The table has the source's columns, the metadata and those that came later; names that differ in case alone are one."""
    o = read(spark, d, "orders")
    t = VersionedTable(spark, scratch(spark, "table"), "o_orderkey", by_day="synced_at", buckets=4)
    t.ensure(schema.with_metadata(o.schema))
    t.ensure(o.select(F.col("o_custkey").alias("O_CUSTKEY"), F.lit("x").alias("extra")).schema)
    return spark.createDataFrame([(n,) for n in t.read().columns], "name string")


@query("SELECT name, n_sorted FROM (VALUES ('day_and_text', 2), ('day_and_double', 1), ('number', 1), ('double', 0)) t(name, n_sorted)")
def table_layout(spark, d):
    o = read(spark, d, "orders").withColumn("synced_at", F.current_timestamp())
    n = lambda pk, day=None: len(layout(o.schema, pk, day))
    rows = [("day_and_text", n("o_orderstatus", "synced_at")), ("day_and_double", n("o_totalprice", "synced_at")), ("number", n("o_orderkey")), ("double", n("o_totalprice"))]
    return spark.createDataFrame(rows, "name string, n_sorted int")


@query("SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_totalprice AS price FROM orders")
def staged_load(spark, d):
    """Rows staged for a job, staged again by its retry, loaded once; encoded strictly."""
    t, o = _sink(spark, d)
    text = o.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    wanted = o.withColumn("o_custkey", F.col("o_custkey").cast("long")).schema
    for _ in range(2):
        staged = t.stage(strict(text, wanted), "job-1")
    t.append(staged)
    return t.read()


# --- values -------------------------------------------------------------------------------------------


@query("""SELECT event_id, event_id % 2 = 0 AS flag, (event_id * 1000000 + 250000) AS us, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  lpad(CAST(event_id % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || ':07' || CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN '.250' ELSE '.000001' END AS time FROM events""")
def strict_values(spark, d):
    i = F.col("event_id")
    of_day = (i % 24) * 3_600_000_000 + (i % 60) * 60_000_000 + 7_000_000 + F.when(i % 3 == 0, 0).when(i % 3 == 1, 250_000).otherwise(1)
    return read(spark, d, "events").select(
        "event_id", X.strict(F.when(i % 2 == 0, "T").otherwise("0"), "boolean").alias("flag"), X.strict(F.concat(i.cast("string"), F.lit(".25")), "epoch").alias("us"), X.date_text(F.col("ts")).alias("day"), X.time_text(of_day).alias("time"),
    )


@query("SELECT event_id, CAST(event_id * 4294967296 + event_id % 1000 - (event_id // 2 * 4294967296 + 7) AS BIGINT) AS behind, event_id % 3 = 0 AND event_id % 5 <> 0 AS lost FROM events")
def lsn_behind(spark, d):
    i = F.col("event_id")
    now, saved = F.concat(F.hex(i), F.lit("/"), F.hex(i % 1000)), F.concat(F.hex(F.expr("event_id div 2")), F.lit("/7"))
    lost = X.continuity_lost(i % 3 != 0, F.when(i % 5 != 0, saved))
    return read(spark, d, "events").select("event_id", X.lsn_behind(now, saved).cast("long").alias("behind"), lost.alias("lost"))


@query(JOBS + f"SELECT DISTINCT attempt_count, least({BACKOFF}, 900) AS seconds FROM jobs")
def snapshot_backoff(spark, d):
    return jobs(spark, d).select("attempt_count", X.snapshot_backoff_seconds(F.col("attempt_count")).alias("seconds")).distinct()


@query("SELECT event_id, substr(sha256('c1' || chr(0) || event_id), 1, 24) || ':' || event_id // 10 AS fragment_id, 'a:' || event_id % 5 || ',b:0' AS attempt FROM events")
def stable_fragment_id(spark, d):
    i = F.col("event_id")
    both = F.array(F.struct(F.lit("a").alias("job_id"), (i % 5).alias("attempt_count")), F.struct(F.lit("b").alias("job_id"), F.lit(-3).cast("long").alias("attempt_count")))
    return read(spark, d, "events").select("event_id", X.fragment_id(X.stable_id(F.lit("c1"), i), F.expr("event_id div 10")).alias("fragment_id"), X.attempt_key(both).alias("attempt"))


@query("WITH c AS (SELECT user_id % 50 AS connection_id, event_type AS table_key, max(epoch_us(ts) // 1000000) AS s FROM events GROUP BY 1, 2) SELECT connection_id, CAST(max(greatest(2000000000 - s, 0)) AS BIGINT) AS age_s FROM c WHERE table_key <> 'view' GROUP BY 1")
def connection_checkpoint_age(spark, d):
    e = read(spark, d, "events")
    c = e.groupBy((F.col("user_id") % 50).alias("connection_id"), F.col("event_type").alias("table_key")).agg(F.floor(F.max(X.micros("ts")) / 1_000_000).cast("long").alias("synced_s"))
    configured = c.where("table_key <> 'view'").select("connection_id", "table_key")
    return stats.connection_age(c, configured, 2_000_000_000)


@query("SELECT table_name, rows_read FROM (SELECT user_id AS run_id, event_type AS table_name, count(*) AS rows_read FROM events GROUP BY 1, 2) WHERE run_id = 7 ORDER BY rows_read DESC, table_name")
def run_tables(spark, d):
    m = read(spark, d, "events").groupBy(F.col("user_id").alias("run_id"), F.col("event_type").alias("table_name")).agg(F.count("*").alias("rows_read"))
    return stats.run_tables(m, 7).select("table_name", "rows_read")


# --- rules of the control side ------------------------------------------------------------------------


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id + 1 WHEN 1 THEN (event_id + 1) * 60 WHEN 2 THEN (event_id + 1) * 3600 WHEN 3 THEN (event_id + 1) * 86400 ELSE event_id + 1 END AS seconds FROM events")
def schedule_seconds(spark, d):
    text = F.concat((F.col("event_id") + 1).cast("string"), F.element_at(F.array(*[F.lit(x) for x in ("s", "m", "h", "d", "")]), (F.col("event_id") % 5 + 1).cast("int")))
    return read(spark, d, "events").select("event_id", control.schedule_column(text).alias("seconds"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id FROM nation WHERE n_nationkey % 3 <> 0")
def enabled_connections(spark, d):
    n = read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), (F.col("n_nationkey") % 3 != 0).alias("enabled"))
    return control.enabled(n).select("id")


@query("""SELECT n_name AS name, CASE WHEN n_nationkey % 4 = 0 THEN 'type_changed' WHEN n_nationkey % 4 = 1 THEN 'added' WHEN n_nationkey % 4 = 2 THEN 'removed' ELSE 'nullable_changed' END AS change,
  n_nationkey % 4 = 0 AS stops_auto, true AS stops_fail FROM nation""")
def schema_policy(spark, d):
    of = F.element_at(F.array(*[F.lit(x) for x in ("type_changed", "added", "removed", "nullable_changed")]), (F.col("n_nationkey") % 4 + 1).cast("int"))
    n = read(spark, d, "nation").select(F.col("n_name").alias("name"), of.alias("change"))
    return n.select("name", "change", schema.stops(F.col("change"), "auto").alias("stops_auto"), schema.stops(F.col("change"), "fail").alias("stops_fail"))


@query("SELECT n_name AS name, CASE n_nationkey % 4 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true ELSE false END AS changed FROM nation")
def key_changes(spark, d):
    """A saved key decides; without one, a fingerprint that differs although no column does."""
    k = F.col("n_nationkey") % 4
    saved, fingerprint, differs = F.when(k == 0, "id").when(k == 1, "old"), F.when(k == 2, "f0").when(k == 3, "f0"), k == 3
    return read(spark, d, "nation").select(F.col("n_name").alias("name"), schema.key_changed_column(saved, F.lit("id"), fingerprint, F.lit("f1"), differs).alias("changed"))


@query("SELECT event_type, count(DISTINCT user_id) AS fingerprints FROM events GROUP BY 1")
def schema_fingerprints(spark, d):
    """Equal schemas have one fingerprint, others differ: one column of each user's name stands in the schema of a table."""
    e = read(spark, d, "events")
    column = F.struct(F.concat(F.lit("c"), "user_id").alias("name"), F.lit("long").alias("type"), F.lit(True).alias("nullable"))
    return e.groupBy("event_type").agg(F.countDistinct(schema.fingerprint_column(F.col("event_type"), F.lit("id"), F.array(column))).alias("fingerprints"))


@query("SELECT event_id // 4 AS window_id, CAST(count(*) AS INTEGER) AS n_steps, bool_and(event_id % 5 <> 0) AS reducer FROM events GROUP BY 1")
def window_payloads(spark, d):
    i = F.col("event_id")
    p = read(spark, d, "events").select(F.expr("event_id div 4").alias("window_id"), i.alias("first_sequence"), F.lit("t").alias("target_table"), F.lit("id").alias("primary_key"), F.lit(False).alias("truncate"), F.when(i % 5 != 0, "{}").alias("staging_schema"), F.array(i).alias("steps"))
    return control.merged_payloads(p, "window_id").select("window_id", F.size("steps").alias("n_steps"), "reducer")
