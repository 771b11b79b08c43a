"""Slices of a source table: pages, cursors, key ranges, summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, pk: str, last, size: int, row_filter: str | None = None) -> DataFrame:
    """The next rows by key."""
    rows = df.where(row_filter) if row_filter else df
    return (rows if last is None else rows.where(F.col(pk) > F.lit(last))).orderBy(pk).limit(size)


def after_cursor(df: DataFrame, updated: str, pk: str, cursor, last_pk=None, row_filter: str | None = None) -> DataFrame:
    """Strictly after (time, key); rows without a time are never read."""
    rows = df.where(row_filter) if row_filter else df
    newer = F.col(updated) > F.lit(cursor)
    return rows.where(newer if last_pk is None else newer | ((F.col(updated) == F.lit(cursor)) & (F.col(pk) > F.lit(last_pk))))


def slice_after(df: DataFrame, updated: str, pk: str, cursor, last_pk, size: int, row_filter: str | None = None) -> DataFrame:
    return after_cursor(df, updated, pk, cursor, last_pk, row_filter).orderBy(updated, pk).limit(size)


def source_summary(df: DataFrame, updated: str | None, row_filter: str | None = None) -> DataFrame:
    rows = df.where(row_filter) if row_filter else df
    return rows.agg(F.count("*").alias("row_count"), (F.max(updated) if updated else F.lit(None)).alias("max_updated_at"))


def destination_summary(df: DataFrame, synced: str = "synced_at", deleted: str = "deleted_at") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(synced).alias("max_synced_at"), F.count_if(F.col(deleted).isNotNull()).alias("deleted_rows"))


def bounds(df: DataFrame, pk: str, row_filter: str | None = None) -> DataFrame:
    rows = df.where(row_filter) if row_filter else df
    return rows.agg(F.count("*").alias("row_count"), F.min(pk).alias("min_pk"), F.max(pk).alias("max_pk"))


@dataclass(frozen=True)
class Chunk:
    start: int
    end: int
    last: int | None = None
    complete: bool = False


def plan_chunks(rows: int, low: int, high: int, batch: int, most: int) -> list[Chunk]:
    """Inclusive key ranges; none where a split would not pay."""
    if rows <= 0 or batch == 0 or most <= 1 or low >= high or rows < batch * 8 * most:
        return []
    span = high - low + 1
    n = min(most, span)
    step = -(-span // n)
    return [Chunk(low + i * step, high if i == n - 1 else low + (i + 1) * step - 1) for i in range(n)]


def chunk_rows(df: DataFrame, pk: str, chunk: Chunk) -> DataFrame:
    """A chunk, or what is left of it after its last key."""
    rows = df.where(F.col(pk).between(chunk.start, chunk.end))
    return rows if chunk.last is None else rows.where(F.col(pk) > chunk.last)


def to_resume(chunks: list[Chunk]) -> list[Chunk]:
    return [c for c in chunks if not c.complete]


def chunk_table(summary: DataFrame, batch: int, most: int) -> DataFrame:
    """The plan as rows, from a row of bounds, without the driver."""
    span = F.col("max_pk") - F.col("min_pk") + 1
    s = summary.where((F.col("row_count") > 0) & (F.col("min_pk") < F.col("max_pk")) & (F.col("row_count") >= batch * 8 * most))
    s = s.withColumn("n", F.least(F.lit(most).cast("long"), span)).withColumn("step", F.ceil(span / F.col("n")).cast("long"))
    s = s.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    start = F.col("min_pk") + F.col("i") * F.col("step")
    return s.select(F.col("i").alias("chunk"), start.alias("range_start"), F.when(F.col("i") == F.col("n") - 1, F.col("max_pk")).otherwise(start + F.col("step") - 1).alias("range_end"))
