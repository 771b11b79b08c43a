"""Run statistics, reconciliation, throughput and health."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bytes of log that an idle connection may lag behind, and tables that a status shows.
IDLE_GAP, MOST_SHOWN = 1_000_000, 25


def run_totals(measures: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    return measures.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in counters])


def attributed_ms(parts: DataFrame, by: str, order: str, rows: str, total_ms: str) -> DataFrame:
    """A commit's extract time by share of rows; the last table takes the remainder."""
    per, w = W.partitionBy(by), W.partitionBy(by).orderBy(order)
    share = F.floor(F.col(total_ms) * F.greatest(F.col(rows), F.lit(1)) / F.greatest(F.sum(rows).over(per), F.lit(1))).cast("long")
    p = parts.withColumn("_share", share)
    last = F.row_number().over(W.partitionBy(by).orderBy(F.desc(order))) == 1
    before = F.coalesce(F.sum("_share").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return p.withColumn("attributed_ms", F.when(last, F.greatest(F.col(total_ms) - before, F.lit(0))).otherwise(F.col("_share")).cast("long")).drop("_share")


def rates(snapshots: DataFrame, run: str, at_ms: str, counter: str) -> DataFrame:
    """Per second, between consecutive snapshots of one run (NULL at its first); counters never run backwards."""
    w = W.partitionBy(run).orderBy(at_ms)
    d = F.greatest(F.col(counter) - F.lag(counter).over(w), F.lit(0))
    t = F.greatest(F.col(at_ms) - F.lag(at_ms).over(w), F.lit(1))
    return snapshots.withColumn("rate", F.when(F.lag(at_ms).over(w).isNotNull(), F.round(d * 1000.0 / t, 6)))


def checkpoint_age(checkpoints: DataFrame, now_s: int, synced_s: str = "synced_s") -> DataFrame:
    return checkpoints.withColumn("age_s", F.when(F.col(synced_s).isNotNull(), F.greatest(F.lit(now_s) - F.col(synced_s), F.lit(0))).cast("long"))


def connection_age(checkpoints: DataFrame, configured: DataFrame, now_s: int, key: str = "table_key") -> DataFrame:
    """Age of the oldest checkpoint of each connection's configured tables."""
    c = checkpoint_age(checkpoints, now_s).join(configured.select("connection_id", key), ["connection_id", key], "left_semi")
    return c.groupBy("connection_id").agg(F.max("age_s").alias("age_s"))


def run_tables(measures: DataFrame, run) -> DataFrame:
    """A run's tables, those with most rows read first."""
    return measures.where(F.col("run_id") == run).orderBy(F.desc("rows_read"), "table_name")


def reconciled(source: DataFrame, destination: DataFrame, soft_delete: bool, key: str = "table_key") -> DataFrame:
    """Source count against destination count, tombstones left out if there are any."""
    live = F.col("dest_rows") - (F.coalesce("dest_deleted", F.lit(0)) if soft_delete else F.lit(0))
    both = source.join(destination, key, "full_outer")
    return both.select(key, "source_rows", "dest_rows", "dest_deleted", F.coalesce(F.col("source_rows") == live, F.lit(False)).alias("count_match"))


def recent_runs(runs: DataFrame, k: int) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(max(1, k))


def table_progress(config: DataFrame, checkpoints: DataFrame, stats: DataFrame, key: str = "table_key") -> DataFrame:
    return config.join(checkpoints, key, "full_outer").join(stats, key, "full_outer")


def active_tables(progress: DataFrame, most: int = MOST_SHOWN) -> DataFrame:
    """Tables in trouble, with snapshot chunks, or with rows moved in this run; the first by name."""
    moved = [F.coalesce(F.col(c), F.lit(0)) > 0 for c in ("snapshot_chunks_total", "rows_read", "rows_written", "rows_deleted", "rows_upserted")]
    return progress.where(reduce(lambda a, b: a | b, moved, F.coalesce(F.col("phase").isin("error", "blocked"), F.lit(False)))).orderBy("table_key").limit(most)


def snapshot_tables(progress: DataFrame, most: int = MOST_SHOWN) -> DataFrame:
    """Tables whose snapshot has chunks left; the first by name."""
    return progress.where("snapshot_chunks_total > 0 and snapshot_chunks_complete < snapshot_chunks_total").orderBy("table_key").limit(most)


def connection_mode(incomplete: Column, log_kind: Column, runtime: Column) -> Column:
    """snapshot or mixed while chunks are left, else by the kind of log (`stream`, `cdc`, none)."""
    while_open = F.when(runtime == "following", "mixed").otherwise("snapshot")
    return F.when(incomplete, while_open).when(log_kind == "stream", "kinesis").when(log_kind == "cdc", "cdc").otherwise("scheduled_polling")


def connection_phase(status: Column, incomplete: Column, log_kind: Column, runtime: Column, error_reason: Column) -> tuple[Column, Column]:
    """(phase, reason) of a connection from its last run, its snapshot and what its log reader does."""
    reason = F.coalesce(error_reason, F.lit("last_run_failed"))
    stopped = reason.isin("schema_blocked", "publication_blocked")
    running = status == "running"
    rules = [
        (running & incomplete, "snapshotting", "snapshot_in_progress"), (running & (log_kind == "stream"), "running", "kinesis_following"),
        (running & (runtime == "following"), "running", "cdc_following"), (running & (runtime == "continuity_lost"), "blocked", "cdc_continuity_lost"),
        (running & (runtime == "unknown"), "starting", "cdc_state_unknown"), (running & (runtime == "initializing"), "starting", "cdc_initializing"),
        (running, "syncing", "sync_in_progress"), ((status == "failed") & stopped, "blocked", reason), (status == "failed", "error", reason),
        (status == "success", "healthy", "healthy"),
    ]
    return _first(rules, "idle", "never_synced")


def _first(rules: list[tuple], *otherwise) -> tuple[Column, ...]:
    """The values of the first rule that holds (an unknown condition does not), one column for each place."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return tuple(F.coalesce(*[F.when(r[0], as_column(r[k + 1])) for r in rules], as_column(otherwise[k])) for k in range(len(otherwise)))


def insight(rows: DataFrame) -> DataFrame:
    """status and blocker of each row of measures; no row if nothing samples it and both summaries are absent.

    Missing counts are none. Work that waits or retries counts as moving while jobs complete.
    """
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    completes = (z("rows_per_minute") > 0) | (z("jobs_per_minute") > 0)
    queue = (z("pending_fragments") > 0) | (z("pending_jobs") > 0) | (z("running_jobs") > 0)
    gap = (z("wal_bytes_behind") >= IDLE_GAP) & ~queue
    all_failed = lambda *cs: (z(cs[0]) > 0) & (sum((z(c) for c in cs[1:]), z(cs[0])) == z("failed_jobs"))
    waits, watched = F.when(completes, "moving").otherwise("backlogged"), F.when(completes, "watch").otherwise("backlogged")
    status, blocker = _first(
        [
            (~F.col("sampler_status").eqNullSafe("ok"), "unknown", "cdc_sampler"),
            ((z("failed_fragments") > 0) | (z("failed_permanent_jobs") > 0), "blocked", "failed_work"),
            (z("snapshot_handoff_waiting_jobs") > 0, waits, "snapshot_handoff_wait"), (all_failed("failed_snapshot_handoff_jobs"), waits, "snapshot_handoff_retry"),
            (all_failed("failed_retryable_jobs"), waits, "retryable_job_backoff"),
            (all_failed("failed_unclassified_jobs", "failed_retryable_jobs"), watched, "unclassified_failed_jobs"),
            (z("failed_jobs") > 0, "blocked", "failed_work"), (completes, "moving", "none"),
            ((F.col("slot_active") == F.lit(False)) & gap, "blocked", "slot_inactive"), ((z("sequence_lag") > 0) & ~queue, "blocked", "feedback_gap"),
            (gap, "watch", "none"), (queue, "backlogged", "staging_or_reducer_backlog"),
        ],
        "idle", "none",
    )
    shown = ~F.col("sampler_status").eqNullSafe("disabled") | F.col("pending_jobs").isNotNull() | F.col("pending_fragments").isNotNull()
    return rows.where(shown).withColumns({"status": status, "blocker": blocker})


def assembled(checkpoints: DataFrame) -> DataFrame:
    """Per connection: entities, newest change, and how many have snapshot chunks left, from the stored JSON."""
    parsed = F.from_json("checkpoint_json", "snapshot_chunks array<struct<complete boolean>>")
    open_ = F.coalesce(F.exists(parsed["snapshot_chunks"], lambda c: ~c["complete"]), F.lit(False))
    return checkpoints.groupBy("connection_id").agg(F.count("*").alias("entities"), F.max("updated_at").alias("newest"), F.count_if(open_).alias("incomplete"))


def persisted(stored: DataFrame, run: DataFrame, key: str = "run_id") -> DataFrame:
    """The stored rows with all of the given runs replaced, so a repeated write changes nothing."""
    return stored.join(run.select(key).distinct(), key, "left_anti").unionByName(run)
