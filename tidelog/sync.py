"""Polling runs: tables of a source into versioned tables, with checkpoints, schema policy and run statistics."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.scalars import deleted_at
from .operators import incremental, schema, stats
from .storage import Lease, VersionedTable



def _fields(**kinds) -> T.StructType:
    return T.StructType([T.StructField(n, k()) for n, k in kinds.items()])


CHECKPOINTS = _fields(entity_name=T.StringType, cursor=T.TimestampType, last_primary_key=T.StringType, schema_json=T.StringType, primary_key=T.StringType, last_synced_s=T.LongType)
RUNS = _fields(
    run_id=T.StringType, table_name=T.StringType, connection_id=T.StringType, started_s=T.LongType, mode=T.StringType, rows_read=T.LongType, status=T.StringType, error=T.StringType,
)


@dataclass(frozen=True)
class Table:
    """What is configured of a table; an empty column list means all."""

    name: str
    primary_key: str
    updated_at_column: str | None = None
    soft_delete_column: str | None = None
    where_clause: str | None = None
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()


@dataclass
class Connection:
    """A source whose tables are read by `read`, and the folder of its tables and state."""

    id: str
    read: object
    root: str
    tables: list[Table]
    policy: str = "auto"
    enabled: bool = True
    buckets: int = 64
    settings: dict = field(default_factory=dict)


class Sync:
    """Runs, status, report, validation and reconciliation of one connection."""

    def __init__(self, spark: SparkSession, connection: Connection):
        self.spark, self.connection = spark, connection
        root = connection.root.rstrip("/")
        self.checkpoints = VersionedTable(spark, f"{root}/state/checkpoints", "entity_name", buckets=1)
        self.runs = VersionedTable(spark, f"{root}/state/runs", buckets=1)
        self.checkpoints.ensure(CHECKPOINTS)
        self.runs.ensure(RUNS)
        self.lease = Lease(spark, f"{root}/state/leases")

    def target(self, table: Table) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.connection.root.rstrip('/')}/tables/{table.name}", table.primary_key, by_day="synced_at", buckets=self.connection.buckets)

    def source(self, table: Table) -> DataFrame:
        df = self.connection.read(table.name)
        needed = [c for c in (table.primary_key, table.updated_at_column, table.soft_delete_column) if c]
        rows = df.where(table.where_clause) if table.where_clause else df
        return rows.select(*schema.select_columns(df.columns, list(table.include), list(table.exclude), needed))

    def checkpoint(self, table: Table):
        return self.checkpoints.read().where(F.col("entity_name") == table.name).first()

    def changes(self, table: Table) -> list[tuple[str, str]]:
        """(column, change) against the schema of the last run; none without one."""
        saved = self.checkpoint(table)
        if not saved or not saved["schema_json"]:
            return []
        rows = lambda s: self.spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in s], "name string, data_type string, nullable boolean")
        old = T.StructType.fromJson(json.loads(saved["schema_json"]))
        return sorted(map(tuple, schema.diff(rows(old), rows(self.source(table).schema)).collect()))

    def validate(self) -> dict[str, str]:
        """Tables that cannot be run, and why."""
        bad = {}
        for t in self.connection.tables:
            try:
                self.source(t)
                saved = self.checkpoint(t)
                changed = schema.key_changed(saved and saved["primary_key"], None, schema.TableSchema(t.name, T.StructType(), t.primary_key), False)
                schema.check_policy(self.changes(t), changed, self.connection.policy)
            except Exception as e:  # noqa: BLE001 - every reason is reported
                bad[t.name] = str(e).split("\n")[0]
        return bad

    def run(self, now_s: int, full: bool = False, dry_run: bool = False, run_id: str | None = None) -> list[tuple[str, str, int]]:
        """One pass over all tables: (table, status, rows read). A table that fails does not stop the others; a second run at once is refused."""
        run_id, owner, out = run_id or uuid.uuid4().hex, uuid.uuid4().hex, []
        if not self.lease.acquire(self.connection.id, owner):
            raise RuntimeError(f"{self.connection.id} is already locked")
        try:
            bad = self.validate()
            for t in self.connection.tables:
                mode = "full" if full or not t.updated_at_column else "incremental"
                try:
                    if t.name in bad:
                        raise ValueError(bad[t.name])
                    n, status, error = self._run_table(t, mode, now_s, run_id, dry_run), "success", None
                except Exception as e:  # noqa: BLE001 - kept as the table's error
                    n, status, error = 0, "failed", str(e).split("\n")[0]
                out.append((t.name, status, n))
                if not dry_run:
                    row = [(run_id, t.name, self.connection.id, now_s, mode, n, status, error)]
                    self.runs.append(self.spark.createDataFrame(row, RUNS), name=f"{run_id}-{t.name}")
                self.lease.acquire(self.connection.id, owner)
        finally:
            self.lease.release(self.connection.id, owner)
        return out

    def _run_table(self, t: Table, mode: str, now_s: int, run_id: str, dry_run: bool) -> int:
        rows, saved = self.source(t), self.checkpoint(t)
        kind = rows.schema[t.primary_key].dataType
        if mode == "incremental" and saved and saved["cursor"] is not None:
            last = F.lit(saved["last_primary_key"]).cast(kind) if saved["last_primary_key"] is not None else None
            rows = incremental.after_cursor(rows, t.updated_at_column, t.primary_key, saved["cursor"], last)
        elif mode == "incremental":
            rows = rows.where(F.col(t.updated_at_column).isNotNull())
        # what the pass has read is where the next one goes on
        end = F.max(F.struct(F.col(t.updated_at_column).cast("timestamp").alias("at"), F.col(t.primary_key).alias("pk"))) if t.updated_at_column else F.lit(None)
        now = F.timestamp_seconds(F.lit(now_s))
        gone = F.lit(None).cast("timestamp")
        if t.soft_delete_column:
            gone = deleted_at(F.col(t.soft_delete_column), rows.schema[t.soft_delete_column].dataType.simpleString(), now).cast("timestamp")
        out = rows.withColumns({"synced_at": now, "deleted_at": gone})
        if dry_run:
            return rows.count()
        staged = self.target(t).stage(out, f"{run_id}-{t.name}-read")
        n, last = staged.agg(F.count("*"), end).first()
        target = self.target(t)
        target.write_batch(staged, name=f"{run_id}-{t.name}", mode="append" if mode == "full" else "upsert", truncate_first=mode == "full")
        at, pk = (last["at"], last["pk"]) if last is not None and last["at"] is not None else (saved and saved["cursor"], saved and saved["last_primary_key"])
        row = [(t.name, at, None if pk is None else str(pk), self.source(t).schema.json(), t.primary_key, now_s)]
        self.checkpoints.write_batch(self.spark.createDataFrame(row, CHECKPOINTS), name=f"{run_id}-{t.name}")
        return n

    def status(self, now_s: int) -> DataFrame:
        """Age of each table's checkpoint."""
        return stats.checkpoint_age(self.checkpoints.read(), now_s, "last_synced_s").select("entity_name", "cursor", "last_primary_key", "age_s")

    def report(self, runs: int = 20) -> DataFrame:
        """The last runs and their totals, the newest first."""
        totals = self.runs.read().groupBy("run_id").agg(F.min("started_s").alias("started_at"), F.sum("rows_read").alias("rows_read"), F.count_if(F.col("status") == "failed").alias("failed_tables"))
        return stats.recent_runs(totals, runs)

    def reconcile(self) -> DataFrame:
        """Source count against destination count of each table."""
        source = destination = None
        for t in self.connection.tables:
            one = self.source(t).agg(F.count("*").alias("source_rows")).select(F.lit(t.name).alias("table_key"), "source_rows")
            two = self.target(t).read().agg(F.count("*").alias("dest_rows"), F.count_if(F.col("deleted_at").isNotNull()).alias("dest_deleted")).select(F.lit(t.name).alias("table_key"), "*")
            source, destination = (one, two) if source is None else (source.unionByName(one), destination.unionByName(two))
        return stats.reconciled(source, destination, False)
