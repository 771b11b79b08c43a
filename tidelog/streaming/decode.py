"""A logical log's messages as change rows: committed transactions, relations as they were, truncates of each table.

Messages are rows: position (a whole number), tx, kind (begin, commit, relation, insert, update, delete, truncate), commit_lsn (of begin and
commit), rel_id, rel_ids (of a truncate), columns (of a relation: array<struct<name, type>>), before and after (JSON rows).
Messages of a transaction share its tx; positions rise in the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DATA = ("insert", "update", "delete", "truncate")
#: Messages in a span of the log, within which changes and relations are ordered together.
SPAN = 65_536


def committed_changes(messages: DataFrame, tables: DataFrame, most_pending: int | None = None) -> DataFrame:
    """Changes of committed transactions to configured tables (rel_id, table): tx, commit_lsn, commit_position, tx_ordinal, op, table, before, after, columns.

    Only the transaction's commit makes its changes count; ordinals number a transaction's changes of configured tables from 0; a truncate is a
    change of each of its tables; `columns` is the table's newest relation at that point of the log, NULL before the first. A
    transaction of more than `most_pending` changes is an error.
    """
    commits = messages.where("kind = 'commit'").select(F.col("tx").alias("_tx"), F.col("commit_lsn").alias("_lsn"), F.col("position").alias("commit_position"))
    t = F.broadcast(tables.select(F.col("rel_id").alias("_rel"), F.col("table")))
    data = messages.where(F.col("kind").isin(*DATA))
    data = data.withColumn("_of", F.explode(F.when(F.col("kind") == "truncate", F.col("rel_ids")).otherwise(F.array("rel_id"))))
    data = data.join(t, F.col("_of") == F.col("_rel")).join(commits, F.col("tx") == F.col("_tx"))
    if most_pending is not None:
        few = F.assert_true(F.count("*").over(W.partitionBy("tx")) <= most_pending, "a transaction has too many pending changes").isNull()
        data = data.withColumn("_few", few).where("_few").drop("_few")
    ordinal = F.row_number().over(W.partitionBy("tx").orderBy("position", "table")) - 1
    data = data.withColumn("tx_ordinal", ordinal.cast("long"))
    data = with_relation(data, messages)
    return data.select("tx", F.col("_lsn").alias("commit_lsn"), "commit_position", "tx_ordinal", F.col("kind").alias("op"), "table", "before", "after", "columns")


def with_relation(changes: DataFrame, messages: DataFrame) -> DataFrame:
    """Changes of the messages with their table's newest relation before them.

    The log's positions are cut into equal spans, one for each 65536 messages or so, and a table's changes and relations of a span are one window.
    A relation also stands in every later span that begins before its table's next one: at most a row for each relation and each span of a table.
    """
    n = f"(count(*) div {SPAN} + 4)"
    log = messages.agg(F.expr(f"struct(max(position) div {n} - min(position) div {n} + 1 AS width, max(position) AS last)")).scalar()
    span = lambda at: F.call_function("div", at, log["width"])
    relations = messages.where("kind = 'relation' AND position IS NOT NULL").select(F.col("rel_id").alias("_of"), "position", F.struct("columns").alias("_relation"))
    until = F.coalesce(F.lead("position").over(W.partitionBy("_of").orderBy("position", "_relation")), log["last"])
    relations = relations.withColumn("_until", until).withColumn("_span", F.explode(F.sequence(span(F.col("position")), span(F.col("_until"))))).drop("_until")
    rows = changes.drop("columns").withColumn("_span", span(F.col("position"))).unionByName(relations, allowMissingColumns=True)
    # at one position, which no two messages have, a change would precede the relation
    before = W.partitionBy("_of", "_span").orderBy("position", "_relation").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("columns", F.last("_relation", ignorenulls=True).over(before)["columns"])
    return rows.where("_relation IS NULL").drop("_relation", "_span")


def relation_changes(messages: DataFrame) -> DataFrame:
    """Columns that a relation adds, removes or retypes against the table's relation before it: rel_id, position, name, change."""
    w = W.partitionBy("rel_id").orderBy("position")
    r = messages.where("kind = 'relation'").withColumn("_before", F.lag("columns").over(w)).where("_before IS NOT NULL")
    name = lambda cs: F.transform(cs, lambda c: c["name"])
    type_in = lambda cs, n: F.filter(cs, lambda c: c["name"] == n)[0]["type"]
    rows = r.withColumn("name", F.explode(F.array_union(name(F.col("_before")), name(F.col("columns")))))
    old, new = type_in(F.col("_before"), F.col("name")), type_in(F.col("columns"), F.col("name"))
    change = F.when(old.isNull(), "added").when(new.isNull(), "removed").when(old != new, "type_changed")
    return rows.select("rel_id", "position", "name", change.alias("change")).where("change IS NOT NULL")


def numbered_commits(changes: DataFrame, start: int) -> DataFrame:
    """Changes with `sequence`: commits in the log's order, from the durable start. One row for each commit is ordered, not the changes."""
    commits = changes.select("tx", "commit_position").distinct()
    numbered = commits.select(F.col("tx").alias("_tx"), (F.row_number().over(W.orderBy("commit_position")) - 1 + start).cast("long").alias("sequence"))
    return changes.join(numbered, F.col("tx") == F.col("_tx")).drop("_tx")


def values_of(row: Column, columns: list[str]) -> list[Column]:
    return [F.get_json_object(row, f"$.{c}").alias(c) for c in columns]
