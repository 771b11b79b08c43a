"""Change logs: ordinals, truncates, the last action of each key, tombstones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ORDER = ("sequence", "tx_ordinal")


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in this order. Spark prunes to one row per key before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ORDER]


def after_truncate(log: DataFrame, op: str = "op", table: str = "table") -> DataFrame:
    """What follows each table's last truncate, with `truncated` telling whether there was one.

    The cut is an aggregate of the truncates alone, joined back, so no table is ordered in one task, and tables without one need none.
    """
    cuts = log.where(F.col(op) == "truncate").groupBy(F.col(table).alias("_t")).agg(F.max(F.struct(*ORDER)).alias("_cut"))
    kept = log.join(cuts, log[table].eqNullSafe(F.col("_t")), "left").where(F.col("_cut").isNull() | (F.struct(*ORDER) > F.col("_cut")))
    return kept.withColumn("truncated", F.col("_cut").isNotNull()).drop("_t", "_cut")


def compact(log: DataFrame, keys: list[str], soft_delete: bool, op: str = "op", before: str | None = None, one_table: str | None = None) -> DataFrame:
    """The last action of each key; deletes count only with soft_delete, and, where `before` names the column that says so, with an old row. A NULL key is an error.

    `one_table` names the table that all events must be of; another one is an error.
    """
    rows = log if soft_delete else log.where(F.col(op) != "delete")
    if before is not None:
        rows = rows.where((F.col(op) != "delete") | F.col(before))
    if one_table is not None:
        rows = rows.where(F.assert_true(F.col("table").eqNullSafe(F.lit(one_table)), f"an event is not of table {one_table}").isNull())
    for k in keys:
        rows = rows.where(F.assert_true(F.col(k).isNotNull(), f"primary key {k} is null").isNull())
    return latest(rows, keys, *newest_first())


def uncompacted(log: DataFrame, now: Column, soft_delete: bool, op: str = "op") -> DataFrame:
    """Every change after its table's last truncate as a row of its own, in the log's order; a sink that keeps history appends them.

    Deletes count only with soft_delete, as tombstones.
    """
    rows = after_truncate(log, op).where(F.col(op) != "truncate")
    return with_tombstones(rows if soft_delete else rows.where(F.col(op) != "delete"), now, op)


def with_tombstones(actions: DataFrame, now: Column, op: str = "op", deleted: str = "deleted_at", synced: str = "synced_at") -> DataFrame:
    """A delete becomes an upsert of the old row that bears the time of its deletion."""
    return actions.withColumn(deleted, F.when(F.col(op) == "delete", now)).withColumn(synced, now)


def staging(log: DataFrame, op: str = "op", commits: DataFrame | None = None) -> DataFrame:
    """Columns that a reducer orders by. `commits` (commit_lsn, sequence), one row each, number the log's commits; an unknown one is an error."""
    if commits is not None:
        c = commits.select(F.col("commit_lsn").alias("_commit_lsn"), F.col("sequence").alias("_known"))
        log = log.join(c, F.col("commit_lsn") == F.col("_commit_lsn"), "left")
        log = log.withColumns({"sequence": F.when(F.assert_true(F.col("_known").isNotNull(), "a commit has no sequence").isNull(), F.col("_known")), "_commit_lsn": F.col("commit_lsn")}).drop("_known")
    return log.withColumns({"_sequence": F.col("sequence"), "_tx_ordinal": F.col("tx_ordinal"), "_operation": F.when(F.col(op) == "delete", "delete").otherwise("upsert")})


def split_by_table(log: DataFrame) -> DataFrame:
    """One fragment for each table of a commit, in the order in which the commit names them.

    Where the log has a column `tables`, a truncate names all of its tables there and counts in each of them.
    """
    if "tables" in log.columns:
        log = log.withColumn("table", F.explode(F.when(F.col("op") == "truncate", F.col("tables")).otherwise(F.array("table"))))
    return log.groupBy("sequence", "table").agg(F.count("*").alias("events"), F.min("tx_ordinal").alias("first_ordinal"))


def tx_ordinals(log: DataFrame, tx: str, position: str) -> DataFrame:
    """Places within a transaction, from 0."""
    return log.withColumn("ordinal", (F.row_number().over(W.partitionBy(tx).orderBy(position)) - 1).cast("long"))


def commit_sequences(commits: DataFrame, order: str, start: int, by: str = "connection_id") -> DataFrame:
    """Consecutive numbers for commits from the durable start, per connection."""
    return commits.withColumn("commit_sequence", (F.dense_rank().over(W.partitionBy(by).orderBy(order)) - 1 + start).cast("long"))


def expand_key_changes(log: DataFrame, key: str, old_key: str, op: str = "op") -> DataFrame:
    """Optional repair: an update that moves a key also deletes the old one, just before."""
    moved = log.where((F.col(op) == "update") & (F.col(old_key) != F.col(key)))
    gone = moved.withColumn(op, F.lit("delete")).withColumn(key, F.col(old_key))
    return log.withColumn("moves", F.lit(1)).unionByName(gone.withColumn("moves", F.lit(0)))
