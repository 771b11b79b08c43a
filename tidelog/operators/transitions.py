"""State changes of the work ledger: each takes whole tables and gives the new ones. Times are epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ledger
from .ledger import updated

#: What an enqueue of a job that failed does not take over from the new record.
KEPT_ON_REVIVAL = ("job_id", "connection_id", "attempt_count", "created_at")


def flagged(rows: DataFrame, chosen: DataFrame, keys: list[str], flag: str = "_chosen") -> DataFrame:
    """Rows with a flag that tells whether `chosen` has their keys."""
    names = [f"_key_{k}" for k in keys]
    c = chosen.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct().withColumn(flag, F.lit(True))
    on = [rows[k].eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return rows.join(c, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False))).drop(*names)


def _set(rows: DataFrame, chosen: DataFrame, keys: list[str], only: Column | None = None, **values) -> DataFrame:
    """The rows, these columns set for the chosen ones that also meet the condition."""
    where = F.col("_chosen") if only is None else F.col("_chosen") & only
    return updated(flagged(rows, chosen, keys), where, **{k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}).drop("_chosen")


def enqueued(jobs: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert by job_id: new jobs are added; a known one is revived by the new record if it had failed, and else stays as it is.

    A revived job keeps its attempts and its creation time and loses its error.
    """
    old, new = jobs.alias("old"), incoming.select(*jobs.columns).alias("new")
    both = old.join(new, F.col("old.job_id") == F.col("new.job_id"), "full_outer")
    added, failed = F.col("old.job_id").isNull(), F.col("old.status") == "failed"

    def column(c):
        if c in KEPT_ON_REVIVAL:
            return F.when(added, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        revived = F.lit(None) if c == "last_error" else F.col(f"new.{c}")
        return F.when(added, F.col(f"new.{c}")).when(failed & F.col("new.job_id").isNotNull(), revived).otherwise(F.col(f"old.{c}"))

    return both.select(*[column(c).cast(jobs.schema[c].dataType).alias(c) for c in jobs.columns])


def staging_claimed(jobs: DataFrame, now: int, stale_before: int) -> DataFrame:
    """All jobs; each connection's next one to stage is staged, tried once more and without its error."""
    return _set(jobs, ledger.staging_claim(jobs, stale_before), ["connection_id", "job_id"], stage="staged", attempt_count=F.col("attempt_count") + 1, last_error=None, updated_at=now)


def window_claimed(jobs: DataFrame, now: int, stale_before: int, most: int, fill_ms: int) -> DataFrame:
    """All jobs; those of each connection's next window run."""
    taken = ledger.claim(jobs, now, stale_before, most, fill_ms)
    can = ((F.col("status") == "pending") & (F.col("stage") == "loaded")) | ((F.col("status") == "running") & (F.col("updated_at") < stale_before))
    return _set(jobs, taken, ["connection_id", "job_id"], can, status="running", stage="applying", last_error=None, updated_at=now)


def heartbeat(jobs: DataFrame, held: DataFrame, now: int) -> DataFrame:
    """All jobs; the held ones that are at work are as fresh as now."""
    return _set(jobs, held, ["connection_id", "job_id"], ledger.at_work(), updated_at=now)


def succeeded(items: DataFrame, done: DataFrame, now: int) -> DataFrame:
    """Jobs, or fragments, of these jobs are applied."""
    values = {"status": "succeeded", "stage": "applied", "retry_class": None, "last_error": None, "updated_at": now}
    return _set(items, done, ["connection_id", "job_id"], **{k: v for k, v in values.items() if k in items.columns})


def failed(jobs: DataFrame, errors: DataFrame, now: int) -> DataFrame:
    """Jobs of (connection_id, job_id, error, class), one row each, have failed."""
    e = errors.select(F.col("connection_id").alias("_c"), F.col("job_id").alias("_j"), F.col("error").alias("_error"), F.col("class").alias("_class"))
    both = jobs.join(e, (F.col("connection_id") == F.col("_c")) & (F.col("job_id") == F.col("_j")), "left")
    out = updated(both, F.col("_j").isNotNull(), status=F.lit("failed"), stage=F.lit("failed"), retry_class=F.col("_class"), last_error=F.col("_error"), updated_at=F.lit(now))
    return out.drop("_c", "_j", "_error", "_class")


def handed_off(jobs: DataFrame, waiting: DataFrame, table: str, now: int) -> DataFrame:
    """Running jobs of these wait, blocked, for their table's snapshot."""
    error = F.concat(F.lit(ledger.HANDOFF + " of "), F.col(table))
    return _set(jobs, waiting, ["connection_id", "job_id"], F.col("status") == "running", status="pending", stage="blocked", retry_class=None, last_error=error, updated_at=now)


def handoff_released(jobs: DataFrame, checkpoints: DataFrame, now: int) -> DataFrame:
    """Jobs that wait for a snapshot with no chunk left are loaded again."""
    free = ledger.released(jobs.where((F.col("status") == "pending") & F.col("last_error").startswith(ledger.HANDOFF)), checkpoints)
    return _set(jobs, free, ["connection_id", "job_id"], stage="loaded", last_error=None, updated_at=now)


def refreshed_heads(heads: DataFrame, jobs: DataFrame, tables: DataFrame) -> DataFrame:
    """Heads (connection_id, table_key, job_id, first_sequence), those of the given tables taken from the jobs again."""
    keys = ["connection_id", "table_key"]
    new = ledger.heads(jobs.join(tables.select(*keys).distinct(), keys, "left_semi")).select(*keys, "job_id", "first_sequence")
    return heads.join(tables.select(*keys).distinct(), keys, "left_anti").select(*keys, "job_id", "first_sequence").unionByName(new)


def saved(state: DataFrame, incoming: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keyed upsert of a state table: these columns are set, others of a known row stay, a new row has NULL there."""
    old, new = state.alias("old"), incoming.select(*keys, *columns).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    both = old.withColumn("_old", F.lit(True)).join(new.withColumn("_new", F.lit(True)), on, "full_outer")

    def column(c):
        if c in keys:
            return F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}"))
        return F.when(F.col("_new"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) if c in columns else F.col(f"old.{c}")

    return both.select(*[column(c).cast(state.schema[c].dataType).alias(c) for c in state.columns])


def resync_requested(requests: DataFrame, tables: DataFrame, now: int) -> DataFrame:
    """Requests (connection_id, source_table, requested_at) with these tables asked for now."""
    return saved(requests, tables.select("connection_id", "source_table", F.lit(now).alias("requested_at")).distinct(), ["connection_id", "source_table"], ["requested_at"])


def resync_pending(requests: DataFrame, connection: str) -> DataFrame:
    return requests.where(F.col("connection_id") == connection).orderBy("requested_at", "source_table")


def resync_cleared(requests: DataFrame, tables: DataFrame) -> DataFrame:
    return requests.join(tables, ["connection_id", "source_table"], "left_anti")
