"""Following a change log: files in, micro-batches reduced and merged into a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import after_truncate, compact, with_tombstones
from ..storage import VersionedTable


def change_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Committed transactions as files; order inside comes from sequence and ordinal."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def committed(log: DataFrame, tx: str = "tx", op: str = "op") -> DataFrame:
    """Rows of transactions whose commit is there; it is no row itself."""
    done = log.where(F.col(op) == "commit").select(tx).distinct()
    return log.where(F.col(op) != "commit").join(done, tx, "left_semi")


def apply_batch(table: VersionedTable, batch: DataFrame, batch_id: int, columns: list[str], now, soft_delete: bool = True) -> None:
    """One micro-batch: truncate cut, last action per key, tombstones, one new version. A repeated batch changes nothing."""
    rows = after_truncate(batch)
    truncated = bool(batch.where("op = 'truncate'").head(1))
    last = compact(rows.where("op <> 'truncate'"), [table.pk], soft_delete)
    out = with_tombstones(last, now).select(*columns, "deleted_at", "synced_at")
    table.write_batch(out, name=f"batch-{batch_id}", truncate_first=truncated)


def follow(stream: DataFrame, table: VersionedTable, columns: list[str], checkpoint: str, now, soft_delete: bool = True, once: bool = True, every: str = "2 seconds") -> StreamingQuery:
    """Starts the query; `once` reads what is there and stops, else a batch starts at this interval. A batch is bounded by the stream's files; its own checkpoint is the frontier."""
    w = stream.writeStream.foreachBatch(lambda b, i: apply_batch(table, b, i, columns, now, soft_delete)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()
