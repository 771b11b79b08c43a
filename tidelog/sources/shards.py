"""Following the shards of a stream: where each goes on, what is unread, and the checkpoints after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed value: records that one read of a shard returns at most.
READ_LIMIT = 1000


def place(sequence: str) -> Column:
    """Sequence numbers are whole numbers of any length, as text: longer ones come later."""
    bare = F.regexp_replace(F.col(sequence), "^0+(?=.)", "")
    return F.struct(F.length(bare), bare)


def resume_points(shards: DataFrame, checkpoints: DataFrame, cutover_ms: int | None, stream: str, saved_stream: str | None) -> DataFrame:
    """Shards (shard) -> (shard, kind, sequence, at_ms): after the saved sequence, else from the cutover, else from the start.

    A stream other than the saved one is an error: the table must be rebuilt.
    """
    if saved_stream is not None and saved_stream != stream:
        raise ValueError(f"the stream changed from {saved_stream} to {stream}; rebuild from an export")
    c = checkpoints.select(F.col("shard").alias("_s"), F.col("sequence"))
    rows = shards.select("shard").join(c, F.col("shard") == F.col("_s"), "left")
    known = F.col("sequence").isNotNull()
    kind = F.when(known, "AFTER_SEQUENCE_NUMBER").otherwise("AT_TIMESTAMP" if cutover_ms is not None else "TRIM_HORIZON")
    return rows.select("shard", kind.alias("kind"), "sequence", F.when(~known, F.lit(cutover_ms)).cast("long").alias("at_ms"))


def unread(records: DataFrame, points: DataFrame, limit: int | None = READ_LIMIT) -> DataFrame:
    """Records (shard, sequence, arrival_ms, …) that the points have before them, per shard the first `limit` of them (None: all)."""
    p = points.select(F.col("shard").alias("_s"), F.col("kind").alias("_kind"), F.col("sequence").alias("_after"), F.col("at_ms").alias("_at"))
    rows = records.join(F.broadcast(p), F.col("shard") == F.col("_s"))
    wanted = F.when(F.col("_kind") == "AFTER_SEQUENCE_NUMBER", place("sequence") > place("_after")).when(F.col("_kind") == "AT_TIMESTAMP", F.col("arrival_ms") >= F.col("_at")).otherwise(True)
    rows = rows.where(wanted)
    if limit is not None:
        rows = rows.withColumn("_n", F.row_number().over(W.partitionBy("shard").orderBy(place("sequence")))).where(F.col("_n") <= limit).drop("_n")
    return rows.drop("_s", "_kind", "_after", "_at")


def advanced(checkpoints: DataFrame, applied: DataFrame) -> DataFrame:
    """Checkpoints (shard, sequence) after these records were applied; a shard without any keeps its own."""
    both = checkpoints.select("shard", "sequence").unionByName(applied.select("shard", "sequence"))
    return both.groupBy("shard").agg(F.max_by("sequence", place("sequence")).alias("sequence"))
