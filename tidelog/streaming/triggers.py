"""When batches flush, what may be acknowledged, and how far the durable frontier is."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ledger

IDLE = ("in_tx", "pending_events", "queued_batches", "pending_table_batches", "inflight_dispatch", "inflight_apply", "active_table_applies", "inflight_commits", "durable_backlog")


def ready_tables(pending: DataFrame, now: int, batch_size: int, max_fill_ms: int, most_active: int, inflight: int = 0, force: bool = False) -> DataFrame:
    """Pending tables (table_key, events, first_buffered_at, first_sequence, active) that flush now: full, old or forced, the oldest sequence first.

    A table whose batch is being applied waits, and no more start than hands are free.
    """
    due = F.lit(force) | (F.col("events") >= batch_size) | (F.lit(now) - F.col("first_buffered_at") >= max_fill_ms)
    return pending.where(due & ~F.col("active")).orderBy("first_sequence", "table_key").limit(max(0, most_active - inflight))


def flush_groups(events: DataFrame, batch_size: int, max_fill_ms: int) -> DataFrame:
    """Events (table_key, position, at_ms) with `flush`, the number of the batch of their table: one that is full, or whose first event is too old, is closed before the next event.

    Where a batch ends depends on where it began, so each table is read in order, a few rows at a time; nothing of it is held.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, flush, n, began = None, 0, 0, 0
        for frame in frames:
            out = []
            for key, at in zip(frame["table_key"].tolist(), frame["at_ms"].tolist()):
                if key != table:
                    table, flush, n, began = key, 0, 0, at
                elif n >= batch_size or at - began >= max_fill_ms:
                    flush, n, began = flush + 1, 0, at
                n += 1
                out.append(flush)
            yield frame.assign(flush=pd.Series(out, index=frame.index, dtype="int64"))

    rows = events.select("table_key", "position", "at_ms").repartition("table_key").sortWithinPartitions("table_key", "position")
    return rows.mapInPandas(run, f"table_key {events.schema['table_key'].dataType.simpleString()}, position long, at_ms long, flush long")


def feedback(received: Column, flushed: Column, idle: dict[str, Column]) -> Column:
    """What a keepalive may acknowledge: all that is received only if nothing at all is under way, else what is flushed."""
    missing = [c for c in IDLE if c not in idle]
    if missing:
        raise ValueError(f"unknown whether idle: {missing}")
    at_rest = F.lit(True)
    for c in IDLE:
        at_rest = at_rest & F.coalesce(idle[c], F.lit(False))
    return F.when(at_rest & (received > flushed), received).otherwise(flushed)


def stops(follow: Column, idle_s: Column, limit_s: float = 10.0) -> Column:
    return ~follow & (idle_s >= limit_s)


def acknowledged(fragments: DataFrame, boundary: str, backlog_cap: int | None = None) -> DataFrame:
    """Fragments (…, landed boolean, applied boolean) with `acked`: landing is enough for `durable_enqueue`, which needs a cap on its backlog; `target_apply` waits for the target."""
    if boundary not in ("target_apply", "durable_enqueue"):
        raise ValueError(f"no such boundary: {boundary}")
    if boundary == "durable_enqueue" and backlog_cap is None:
        raise ValueError("durable_enqueue needs a cap on the backlog")
    return fragments.withColumn("acked", F.col("landed") if boundary == "durable_enqueue" else F.col("applied"))


def advanced_frontier(progress: DataFrame, memory: DataFrame, persisted: DataFrame, most: int) -> DataFrame:
    """How far each connection may acknowledge: (connection_id, next_sequence, commit_lsn), where that is further than it was.

    progress: as for `ledger.frontier`; memory and persisted: (connection_id, next_sequence). The scan starts at the smaller of the two.
    """
    m = memory.select(F.col("connection_id").alias("_c"), F.col("next_sequence").alias("_memory"))
    p = persisted.select(F.col("connection_id").alias("_p"), F.col("next_sequence").alias("_persisted"))
    start = m.join(p, F.col("_c") == F.col("_p"), "left").select("_c", "_memory", F.least("_memory", F.coalesce("_persisted", "_memory")).alias("_start"))
    rows = progress.join(start, F.col("connection_id") == F.col("_c"))
    out = ledger.frontier_from(rows, F.col("_start"), most, "_memory")
    return out.where((F.col("next_sequence") > F.col("_start")) & (F.col("next_sequence") >= F.col("_memory"))).select("connection_id", "next_sequence", "commit_lsn")
