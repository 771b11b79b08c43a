"""Snapshots beside a running log: what to read whole, in which order, and when a table's changes may be applied."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .changes import after_truncate, compact, with_tombstones
from .merge import upsert


def scope(tables: DataFrame, full: bool, has_position: bool, keep_backlog: bool) -> DataFrame:
    """Tables (table_key, included, in_progress, resync, new) that are read whole: all that are included at a full sync or without a
    position, else those that need it; and how each is written: what resumes or repeats upserts, else it truncates and appends."""
    everything = full or (not has_position and not keep_backlog)
    need = F.lit(True) if everything else F.col("in_progress") | F.col("resync") | F.col("new")
    again = F.col("resync") | F.col("in_progress")
    return tables.where(F.col("included") & need).select("table_key", F.when(again, "upsert").otherwise("append").alias("mode"), (~again).alias("truncate_first"))


def overlapped(snapshot: DataFrame, log: DataFrame, pk: str, columns: list[str], now: Column, soft_delete: bool = True) -> DataFrame:
    """The current table from a snapshot and the log that ran on meanwhile.

    `snapshot` has the rows and `snapshot_sequence`, the log's position at which its chunk was read; a change counts for a key if
    it came later than the snapshot of that key's row (any change, for a key that the snapshot lacks). A later truncate drops the
    snapshot's rows. The snapshot is the base, the log's last action of each key goes over it.
    """
    rows = log.withColumn("table", F.lit("t"))
    kept = after_truncate(rows).where("op <> 'truncate'")
    last = with_tombstones(compact(kept, [pk], soft_delete), now)
    # one row: the last truncate
    cut = rows.where("op = 'truncate'").agg(F.max("sequence").alias("_cut")).withColumn("_one", F.lit(1))
    base = snapshot.withColumn("_one", F.lit(1)).join(F.broadcast(cut), "_one", "left").where("_cut IS NULL OR snapshot_sequence >= _cut").drop("_cut", "_one")
    positions = base.select(F.col(pk).alias("_pk"), F.col("snapshot_sequence").alias("_at"))
    newer = last.join(positions, F.col(pk) == F.col("_pk"), "left").where(F.col("_at").isNull() | (F.col("sequence") > F.col("_at")))
    return upsert(base.select(*columns).withColumns({"deleted_at": F.lit(None).cast(now_type(last)), "synced_at": now}), newer.select(*columns, "deleted_at", "synced_at"), pk)


def now_type(rows: DataFrame):
    return rows.schema["deleted_at"].dataType


def readiness(jobs: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Jobs with `gate`: `blocked` (done without being applied), `snapshotting` (wait) or `ready`, by their table's checkpoint.

    checkpoints: (table_key, status, chunks array<struct<complete>>).
    """
    c = checkpoints.select(F.col("table_key").alias("_t"), (F.col("status") == "blocked").alias("_blocked"), F.exists("chunks", lambda x: ~F.coalesce(x["complete"], F.lit(False))).alias("_open"))
    gate = F.when(F.col("_blocked"), "blocked").when(F.col("_open"), "snapshotting").otherwise("ready")
    return jobs.join(c, F.col("table_key") == F.col("_t"), "left").withColumn("gate", gate).drop("_t", "_blocked", "_open")


def round_robin(tasks: DataFrame, order: str = "chunk") -> DataFrame:
    """Snapshot tasks (table_key, chunk) in the order in which a scheduler with free hands starts them: each table's next by turns."""
    turn = F.row_number().over(W.partitionBy("table_key").orderBy(order))
    return tasks.withColumn("turn", turn.cast("long")).orderBy("turn", "table_key")


@dataclass
class Task:
    table: str
    run: Callable[[], None]
    upserts: bool = False
    attempts: int = 0
    next_at: float = 0.0


@dataclass
class SnapshotScheduler:
    """Runs snapshot tasks, `most` at once, tables by turns. Tasks that upsert run one at a time for their table.

    A task that fails waits for its delay and is tried again; a table whose error `permanent` tells to be so is blocked: its
    waiting tasks are dropped, the others go on. Returns the blocked tables and their errors.
    """

    most: int
    clock: Callable[[], float]
    sleep: Callable[[float], None]
    delay: Callable[[int], float]
    permanent: Callable[[Exception], bool]
    queues: dict[str, list[Task]] = field(default_factory=dict)
    busy: set[str] = field(default_factory=set)
    turn: int = 0

    def add(self, task: Task) -> None:
        self.queues.setdefault(task.table, []).append(task)

    def next(self) -> tuple[Task | None, float | None]:
        """The next task that may start, and else when one may."""
        names, earliest = sorted(self.queues), None
        for k in range(len(names)):
            at = (self.turn + k) % len(names)
            queue = self.queues[names[at]]
            if not queue or (queue[0].upserts and names[at] in self.busy):
                continue
            if queue[0].next_at > self.clock():
                earliest = min(x for x in (earliest, queue[0].next_at) if x is not None)
                continue
            self.turn = (at + 1) % len(names)
            return queue.pop(0), earliest
        return None, earliest

    def run(self) -> dict[str, str]:
        blocked: dict[str, str] = {}
        with ThreadPoolExecutor(max(1, self.most)) as pool:
            running = {}
            while True:
                earliest = None
                while len(running) < max(1, self.most):
                    task, earliest = self.next()
                    if task is None:
                        break
                    if task.upserts:
                        self.busy.add(task.table)
                    running[pool.submit(task.run)] = task
                if not running:
                    if earliest is None:
                        return blocked
                    self.sleep(max(0.0, earliest - self.clock()))
                    continue
                for f in wait(running, return_when=FIRST_COMPLETED).done:
                    task = running.pop(f)
                    if task.upserts:
                        self.busy.discard(task.table)
                    error = f.exception()
                    if error is None:
                        continue
                    if self.permanent(error):
                        blocked.setdefault(task.table, str(error))
                        self.queues[task.table] = []
                    elif task.table not in blocked:
                        task.attempts += 1
                        task.next_at = self.clock() + self.delay(task.attempts)
                        self.queues[task.table].insert(0, task)
