"""The work ledger: queue summaries, frontiers, heads, windows, clean-up. Times are epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import backoff_seconds, stage_of
from .changes import latest

STATUSES = ("pending", "running", "succeeded", "failed")
STAGES = ("received", "staged", "loaded", "apply_pending", "applying", "applied", "failed", "blocked")
STALE_MS, WINDOW_MS, MINUTE_MS = 90_000, 900_000, 60_000
RETRYABLE = ("backpressure", "transient")
#: Fixed value: how the error of a job begins that waits for its table's snapshot.
HANDOFF = "CDC batch-load waiting for snapshot handoff"


def age_seconds(now: int, ms: Column) -> Column:
    return F.floor(F.greatest(F.lit(now) - ms, F.lit(0)) / 1000).cast("long")


def queue_summary(jobs: DataFrame, now: int) -> DataFrame:
    """Per connection: counts by status, failure and stage, recent completions, ages of the oldest, in one pass."""
    status, stage, kind = F.col("status"), F.col("stage"), F.col("retry_class")
    failed, done = status == "failed", status == "succeeded"
    handoff = F.coalesce(F.col("last_error").startswith(HANDOFF), F.lit(False))
    counts = {"total_jobs": F.lit(True)} | {f"{x}_jobs": status == x for x in STATUSES}
    counts |= {
        "failed_retryable_jobs": failed & kind.isin(*RETRYABLE), "failed_permanent_jobs": failed & (kind == "permanent"),
        "failed_snapshot_handoff_jobs": failed & kind.isin(*RETRYABLE) & handoff,
        "failed_unclassified_jobs": failed & ~F.coalesce(kind.isin(*RETRYABLE, "permanent"), F.lit(False)),
        "snapshot_handoff_waiting_jobs": (stage == "blocked") & handoff, "failed_stage_jobs": stage == "failed",
        "jobs_per_minute": done & (F.col("updated_at") >= now - MINUTE_MS),
    }
    counts |= {f"{x}_jobs": stage == x for x in ("received", "staged", "loaded", "blocked", "applying", "applied")}
    oldest = {"pending": (status == "pending", "created_at"), "running": (status == "running", "updated_at")}
    oldest |= {x: (stage == x, "updated_at") for x in ("received", "loaded", "blocked", "applying")}
    ages = [age_seconds(now, F.min(F.when(cond, F.col(c)))).alias(f"oldest_{x}_age_s") for x, (cond, c) in oldest.items()]
    recent = F.avg(F.when(done & (F.col("updated_at") >= now - WINDOW_MS), F.col("updated_at") - F.col("created_at")))
    return jobs.groupBy("connection_id").agg(*[F.count_if(c).alias(k) for k, c in counts.items()], *ages, F.round(recent, 3).alias("avg_job_duration_ms"))


def step_rows(payload: Column) -> Column:
    """Rows of all steps of a job's JSON payload."""
    steps = F.from_json(payload, "steps array<struct<row_count long>>")["steps"]
    return F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["row_count"], F.lit(0).cast("long"))), F.lit(0).cast("long"))


def of(items: DataFrame, connection: str) -> DataFrame:
    return items.where(F.col("connection_id") == connection)


def top_queued(jobs: DataFrame, connection: str, k: int = 5) -> DataFrame:
    j = of(jobs, connection).where(F.col("status").isin("pending", "running")).withColumn("rows", step_rows(F.col("payload_json")))
    return j.groupBy("table_key").agg(F.count("*").alias("queued_jobs"), F.sum("rows").alias("queued_rows")).orderBy(F.desc("queued_rows"), F.desc("queued_jobs"), "table_key").limit(k)


def top_loaded(jobs: DataFrame, connection: str, now: int, k: int = 5, window_ms: int = WINDOW_MS) -> DataFrame:
    j = of(jobs, connection).where((F.col("status") == "succeeded") & (F.col("updated_at") >= now - window_ms)).withColumn("rows", step_rows(F.col("payload_json")))
    took = F.sum(F.col("updated_at") - F.col("created_at"))
    return j.groupBy("table_key").agg(F.count("*").alias("succeeded_jobs"), F.sum("rows").alias("loaded_rows"), took.alias("total_ms")).orderBy(F.desc("total_ms"), F.desc("succeeded_jobs"), "table_key").limit(k)


def rows_per_minute(jobs: DataFrame, connection: str, now: int) -> DataFrame:
    j = of(jobs, connection).where((F.col("status") == "succeeded") & (F.col("updated_at") >= now - MINUTE_MS))
    return j.agg(F.coalesce(F.sum(step_rows(F.col("payload_json"))), F.lit(0)).cast("long").alias("rows_per_minute"))


def pending_summary(items: DataFrame, connection: str, now: int, most: int | None, oldest_ms: int | None) -> DataFrame:
    """Pending items of a connection, the oldest, and whether either bound is reached."""
    out = of(items, connection).where(F.col("status") == "pending").agg(F.count("*").alias("pending"), F.min("created_at").alias("oldest"))
    age = F.greatest(F.lit(now) - F.col("oldest"), F.lit(0))
    many = F.lit(False) if most is None else F.col("pending") >= most
    return out.select("pending", "oldest", F.coalesce(many | (F.lit(False) if oldest_ms is None else age >= oldest_ms), F.lit(False)).alias("exceeded"))


def backpressure(fragments: DataFrame, jobs: DataFrame, connection: str, now: int, most_fragments: int | None, most_jobs: int | None, oldest_ms: int | None) -> DataFrame:
    """The ledger that holds the stream back, if one does: fragments are looked at first, then jobs."""
    parts = [
        pending_summary(items, connection, now, most, oldest_ms).select(F.lit(place).alias("_place"), F.lit(name).alias("ledger"), "*")
        for place, (name, items, most) in enumerate((("fragments", fragments, most_fragments), ("jobs", jobs, most_jobs)))
    ]
    return parts[0].unionByName(parts[1]).where("exceeded").orderBy("_place").limit(1).select("ledger", "pending", "oldest")


def completeness(fragments: DataFrame) -> DataFrame:
    return fragments.groupBy("job_id").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "succeeded").alias("durable"), F.count_if(F.col("status") == "failed").alias("failed"))


def complete_jobs(fragments: DataFrame) -> DataFrame:
    return completeness(fragments).where("total > 0 and durable = total").select("job_id")


def fragment_progress(sequences: DataFrame, fragments: DataFrame) -> DataFrame:
    """Distinct logical fragments that succeeded, per commit."""
    f = fragments.select("connection_id", "sequence", F.when(F.col("status") == "succeeded", F.struct("table_key", F.coalesce("lane", F.lit("")))).alias("done"))
    return sequences.join(f, ["connection_id", "sequence"], "left").groupBy("connection_id", "sequence", "commit_lsn", "expected_fragments").agg(F.countDistinct("done").alias("succeeded_fragments"))


def frontier(progress: DataFrame, start: int, most: int) -> DataFrame:
    """The contiguous run of complete commits from `start`, at most `most` of them per connection."""
    return frontier_from(progress, F.lit(start), most)


def frontier_from(progress: DataFrame, start: Column, most: int, *kept: str) -> DataFrame:
    """The same from a start of each connection's own, a column of `progress`; other such columns may be kept.

    Only numbers in [start, start + most) can belong to it, so a filter bounds each window.
    """
    rows = progress.withColumn("_from", start).where((F.col("sequence") >= F.col("_from")) & (F.col("sequence") < F.col("_from") + most))
    w = W.partitionBy("connection_id").orderBy("sequence")
    bad = (F.col("sequence") != F.col("_from") + F.row_number().over(w) - 1) | (F.col("succeeded_fragments") < F.greatest(F.col("expected_fragments"), F.lit(1)))
    good = rows.withColumn("_bad", bad.cast("int")).withColumn("_stop", F.max("_bad").over(w)).where("_stop = 0")
    ends = [F.first("_from").alias("_start"), *[F.first(c).alias(c) for c in kept]]
    out = good.groupBy("connection_id").agg((F.first("_from") + F.count("*")).cast("long").alias("next_sequence"), F.max_by("commit_lsn", "sequence").alias("commit_lsn"), *ends)
    return out if kept else out.drop("_start")


OPEN = ("pending", "running", "failed")


def heads(jobs: DataFrame) -> DataFrame:
    """The earliest unfinished job of each table; a failed one blocks its table."""
    j = jobs.where(F.col("status").isin(*OPEN))
    return latest(j, ["connection_id", "table_key"], F.asc("first_sequence"), F.asc("created_at"), F.asc("job_id"))


def _windows(jobs: DataFrame, now: int, stale_before: int, most: int, fill_ms: int) -> DataFrame:
    key, order = ["connection_id", "table_key"], ("first_sequence", "created_at", "job_id")
    per = W.partitionBy(*key)
    fits = F.coalesce((F.col("status") == "pending") & (F.col("stage") == "loaded") & F.col("barrier_kind").isNull() & F.col("reducer_eligible"), F.lit(False))
    eligible = F.coalesce("reducer_eligible", F.lit(False))
    head = F.min(F.when(F.col("status").isin(*OPEN), F.struct(*order, "status", "stage", "updated_at", "barrier_kind", eligible.alias("eligible")))).over(per)
    h = lambda c: F.col("_head")[c]
    stale = (h("status") == "running") & (h("updated_at") < stale_before)
    alone = h("barrier_kind").isNotNull() | ~h("eligible")
    j = jobs.withColumn("_head", head).where((F.col("first_sequence") >= h("first_sequence")) & (stale | ((h("status") == "pending") & (h("stage") == "loaded"))))
    j = j.withColumn("_fits", fits).withColumn("_is_head", F.col("job_id") == h("job_id"))
    j = j.withColumn("_stop", F.min(F.when(~F.col("_is_head") & ~F.col("_fits"), F.col("first_sequence"))).over(per))
    after = F.col("_fits") & ~alone & (F.col("first_sequence") > h("first_sequence")) & (F.col("_stop").isNull() | (F.col("first_sequence") <= F.col("_stop")))
    j = j.where(F.col("_is_head") | after).withColumn("_jobs", F.count("*").over(per))
    j = j.withColumn("place", F.row_number().over(per.orderBy(*order)).cast("long")).where(F.col("place") <= most)
    ready = (h("status") == "running") | (h("updated_at") <= now - fill_ms) | alone | (F.col("_jobs") >= most)
    return j.select(*key, "job_id", h("job_id").alias("head_id"), "place", ready.alias("ready"), F.struct(*[h(c).alias(c) for c in order]).alias("_at"))


def windows(jobs: DataFrame, now: int, stale_before: int, most: int, fill_ms: int) -> DataFrame:
    """Jobs that a reducer may take together, per table, and whether the window is ready.

    The head is loaded, or runs and is stale. Later jobs join it up to the first sequence that holds
    another job, of any status, which does not fit. All of it happens within one partitioning by table.
    """
    return _windows(jobs, now, stale_before, most, fill_ms).drop("_at")


def claim(jobs: DataFrame, now: int, stale_before: int, most: int, fill_ms: int) -> DataFrame:
    """The one window that a connection's next reducer takes: the ready one with the earliest head."""
    w = _windows(jobs, now, stale_before, most, fill_ms).where("ready")
    first = W.partitionBy("connection_id")
    return w.withColumn("_first", F.min("_at").over(first)).where("_at = _first").select("connection_id", "table_key", "job_id", "place")


def doomed(jobs: DataFrame, fragments: DataFrame) -> DataFrame:
    """Unfinished jobs whose fragments are not all durable; a replay discards them."""
    return jobs.where(F.col("status").isin("pending", "running")).select("job_id").join(complete_jobs(fragments), "job_id", "left_anti")


def repaired(fragments: DataFrame, jobs: DataFrame) -> DataFrame:
    """Fragments of succeeded jobs become succeeded."""
    done = jobs.where("status = 'succeeded'").select("job_id", F.lit(True).alias("_done"))
    return fragments.join(done, "job_id", "left").withColumn("status", F.when(F.col("_done"), "succeeded").otherwise(F.col("status"))).drop("_done")


def enqueue_state(fragments: DataFrame) -> DataFrame:
    """Where each connection's enqueued log ends: its newest fragment that is pending, succeeded or failed."""
    f = fragments.where(F.col("status").isin("pending", "succeeded", "failed"))
    end = F.max(F.struct("sequence", "created_at", "commit_lsn")).alias("e")
    return f.groupBy("connection_id").agg(end).select("connection_id", "e.sequence", "e.commit_lsn", "e.created_at")


def fragment_ends(fragments: DataFrame, next_sequence: int) -> DataFrame:
    """Oldest pending and last failed fragment, and how far the frontier lags."""
    pending, failed = F.col("status") == "pending", F.col("status") == "failed"
    return fragments.groupBy("connection_id").agg(
        F.min_by("fragment_id", F.when(pending, F.struct("sequence", "created_at", "fragment_id"))).alias("oldest_pending"),
        F.max_by("fragment_id", F.when(failed, F.struct("updated_at", "sequence", "fragment_id"))).alias("latest_failed"),
        F.greatest(F.max("sequence") - next_sequence, F.lit(0)).alias("sequence_lag"),
    )


def latest_failed_job(jobs: DataFrame) -> DataFrame:
    """The last failed job of each connection."""
    return latest(jobs.where("status = 'failed'"), ["connection_id"], F.desc("updated_at"), F.desc("job_id"))


def hot_tables(pending: DataFrame, table: str, k: int = 8) -> DataFrame:
    return pending.groupBy(table).agg(F.count("*").alias("n")).orderBy(F.desc("n"), table).limit(k)


def staging_claim(jobs: DataFrame, stale_before: int) -> DataFrame:
    """The next job to stage of each connection: the earliest that is received, or staged by one that is gone."""
    free = (F.col("status") == "pending") & ((F.col("stage") == "received") | ((F.col("stage") == "staged") & (F.col("updated_at") < stale_before)))
    return latest(jobs.where(free), ["connection_id"], F.asc("first_sequence"), F.asc("created_at"), F.asc("job_id"))


def at_work() -> Column:
    return (F.col("status") == "running") | ((F.col("status") == "pending") & (F.col("stage") == "staged"))


def stale_jobs(jobs: DataFrame, now: int) -> DataFrame:
    return jobs.where(at_work() & (F.col("updated_at") < now - STALE_MS))


def retry_due(jobs: DataFrame, now: int, jitter: bool = True) -> DataFrame:
    """Failed jobs that may be tried again now, in the order in which they are. The delay varies by table and attempt."""
    delay = backoff_seconds(F.greatest("attempt_count", F.lit(1)), jitter_key=F.concat(F.lit("cdc_batch_load:"), F.col("table_key")) if jitter else None)
    due = F.col("updated_at") + delay * 1000 <= now
    return jobs.where((F.col("status") == "failed") & F.col("retry_class").isin(*RETRYABLE) & due).orderBy("updated_at", "first_sequence", "created_at")


def requeued(jobs: DataFrame, now: int, jitter: bool = True) -> DataFrame:
    """All jobs; those that are due again are pending and received, without their error."""
    delay = backoff_seconds(F.greatest("attempt_count", F.lit(1)), jitter_key=F.concat(F.lit("cdc_batch_load:"), F.col("table_key")) if jitter else None)
    due = F.coalesce((F.col("status") == "failed") & F.col("retry_class").isin(*RETRYABLE) & (F.col("updated_at") + delay * 1000 <= now), F.lit(False))
    return updated(jobs, due, status=F.lit("pending"), stage=F.lit("received"), last_error=F.lit(None), updated_at=F.lit(now))


def updated(rows: DataFrame, where: Column, **values: Column) -> DataFrame:
    """The rows, these columns set where the condition holds; one pass, no join."""
    where = F.coalesce(where, F.lit(False))
    return rows.select(*[F.when(where, values[c]).otherwise(F.col(c)).cast(rows.schema[c].dataType).alias(c) if c in values else F.col(c) for c in rows.columns])


def stage_for(stage: Column, status: Column) -> Column:
    """What is written for a stage: one still `received` follows a status that has moved on."""
    return F.when((stage == "received") & (status != "pending"), stage_of(status)).otherwise(stage)


def scan(items: DataFrame, statuses: list[str]) -> DataFrame:
    """Items of these statuses, a missing stage following from the status, a missing expectation none; in order of their sequence."""
    order = [c for c in ("sequence", "first_sequence") if c in items.columns] + ["created_at"]
    out = items.where(F.col("status").isin(statuses)).withColumn("stage", F.coalesce("stage", stage_of(F.col("status"))))
    if "expected_fragments" in items.columns:
        out = out.withColumn("expected_fragments", F.coalesce("expected_fragments", F.lit(0)))
    return out.orderBy(*order)


def merged_sequences(*parts: DataFrame) -> DataFrame:
    """Keyed upsert of the sequence ledger that keeps the larger expectation."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("connection_id", "sequence").agg(F.max("expected_fragments").alias("expected_fragments"), F.max("commit_lsn").alias("commit_lsn"))


def merged_watermark(feedback: DataFrame, enqueue: DataFrame, legacy: DataFrame, fields: list[str]) -> DataFrame:
    """Field by field, the first of feedback, enqueue and legacy that knows it."""
    k = "connection_id"
    parts = [d.select(k, *[F.col(c).alias(f"{c}_{i}") for c in fields]) for i, d in enumerate((feedback, enqueue, legacy))]
    rows = parts[0].join(parts[1], k, "full_outer").join(parts[2], k, "full_outer")
    return rows.select(k, *[F.coalesce(*[F.col(f"{c}_{i}") for i in range(3)]).alias(c) for c in fields])


def without_blocked(jobs: DataFrame, blocked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(jobs to apply, jobs of blocked tables, which count as done without being applied)."""
    b = blocked.select("table_key").distinct()
    return jobs.join(b, "table_key", "left_anti"), jobs.join(b, "table_key", "left_semi").withColumn("status", F.lit("succeeded"))


def released(jobs: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Blocked jobs whose table has no incomplete snapshot chunk any more."""
    c = checkpoints.select(F.col("table_key").alias("_t"), F.exists("chunks", lambda x: ~x["complete"]).alias("_open"))
    j = jobs.where("stage = 'blocked'").join(c, F.col("table_key") == F.col("_t"), "left")
    return j.where(~F.coalesce("_open", F.lit(False))).drop("_t", "_open")
