"""Merges as joins: upsert, reducer, event-time, truncate."""

from __future__ import annotations

from functools import reduce as fold

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .changes import latest, newest_first


def upsert(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """Matched rows are replaced, others inserted; NULL keys never match. The source is taken as it is."""
    return target.join(source.select(pk), pk, "left_anti").unionByName(source, allowMissingColumns=True)


def reduce_steps(steps: list[DataFrame], pk: str, helpers: tuple[str, ...] = ("sequence", "tx_ordinal")) -> DataFrame:
    """Union of staged steps -> the newest row of each key, without the reducer's columns."""
    rows = fold(lambda a, b: a.unionByName(b, allowMissingColumns=True), steps)
    return latest(rows, [pk], *newest_first()).drop(*helpers)


def reducer_merge(target: DataFrame, steps: list[DataFrame], pk: str) -> DataFrame:
    """Tombstones of unseen keys are inserted too."""
    return upsert(target, reduce_steps(steps, pk), pk)


def event_time_merge(target: DataFrame, source: DataFrame, pk: str, at: str = "event_at", event: str = "event_id", deleted: str = "deleted_at") -> DataFrame:
    """Newer or equal events win; a tombstone for an unseen key is no row.

    The source is first reduced to its newest event per key, NULL times last.
    """
    s = latest(source, [pk], F.col(at).desc_nulls_last(), F.col(event).desc_nulls_last(), F.col(deleted).desc_nulls_last())
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), s.withColumn("_s", F.lit(True)).alias("s")
    both = t.join(s, F.col(f"t.{pk}") == F.col(f"s.{pk}"), "full_outer")
    newer = F.coalesce(F.col(f"t.{at}").isNull() | (F.col(f"s.{at}") > F.col(f"t.{at}")) | ((F.col(f"s.{at}") == F.col(f"t.{at}")) & (F.col(f"s.{event}") >= F.col(f"t.{event}"))), F.lit(False))
    use = F.when(F.col("_t").isNull(), F.col(f"s.{deleted}").isNull()).otherwise(F.col("_s").isNotNull() & newer)
    kept = both.withColumn("_use", use).where(F.col("_use") | F.col("_t").isNotNull())
    return kept.select(*[F.when(F.col("_use"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])


def ranged(kind: str) -> bool:
    """Keys of these types have a range that prunes a merge."""
    return kind in ("bigint", "int", "smallint", "tinyint", "date", "timestamp", "timestamp_ntz") or kind.startswith("decimal")


def key_range(source: DataFrame, pk: str) -> DataFrame:
    return source.agg(F.min(pk).alias("low"), F.max(pk).alias("high"))


def merge_in_range(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """The upsert whose join reads only the target rows within the source's keys; the bounds reach the scan, hence the driver. Other types have no range."""
    if not ranged(target.schema[pk].dataType.simpleString()):
        return upsert(target, source, pk)
    low, high = key_range(source, pk).first()
    if low is None:
        return target.unionByName(source, allowMissingColumns=True)
    inside = F.coalesce(F.col(pk).between(low, high), F.lit(False))
    return target.where(~inside).unionByName(upsert(target.where(inside), source, pk), allowMissingColumns=True)


def truncate(target: DataFrame) -> DataFrame:
    return target.limit(0)
