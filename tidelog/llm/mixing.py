"""Mixing sources to target weights, with DataFrame functions alone.

Each row gets a hash-random key from its id and text. Sums by (source, leading digits of the key) give the
distributed prefix sums: a window over those sums finds, for each source, the one range of
keys in which its budget ends; the same sums over that range's rows find a narrower one, and only rows of
that are sorted for their own running sum. All other rows are decided by their key alone. A hot source is thus
spread over 16 ** RANGE_DIGITS ranges, twice, and never sorted whole; rows of one id, or of none, spread by their texts.

Defined results: null or wordless texts have size 0 and take 0; a null source is a source
of its own, last in order; repeated rows count each, and which of several equal rows the last, partial epoch takes is open;
an empty table gives no rows; other columns are ignored by `mix` and kept by `mixed_documents`. The table of sources (one row
per source) is ordered in one task, and rows that are equal in source, id and text, if they end an epoch, in another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, packed, unpacked

WORD = r"[^\x20\x09-\x0D]+"
#: Weights by the source's place in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times its source's size.
MOST = 3
#: Hexadecimal digits of the key that name its range, and as many more its narrower range: 16 ** 3 for each source, each time.
RANGE_DIGITS = 3
#: The table of sources is broadcast up to so many rows, and joined by shuffle above.
MOST_BROADCAST = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> the same with weight and target; shares capped and reshared.

    Sources are capped in order of cap / weight; the level that the rest share follows from
    running sums in that order, so no iteration is needed.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (place % len(weights) + 1).cast("int")).cast("long")
    t = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * most)
    order = W.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    whole = W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    t = (
        t.withColumn("left_size", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("open", F.col("cap") * F.col("left_weight") > F.col("weight") * F.col("left_size"))
    )
    first = F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("source").isNull().alias("n"), F.col("source").alias("s"))
    level = F.min_by(F.struct("left_size", "left_weight"), F.when(F.col("open"), first))
    t = t.withColumn("level", level.over(whole))
    capped = ~F.col("open") | F.col("level").isNull()
    shared = F.col("weight") * F.col("level.left_size") / F.col("level.left_weight")
    return t.select("source", "source_size", "weight", F.when(capped, F.col("cap").cast("double")).otherwise(shared).alias("target"))


def _ends(sums: DataFrame, plan: DataFrame, start: Column) -> DataFrame:
    """(source, range, range_size) -> the range in which each source's rest ends, and what lies before it."""
    running = F.sum("range_size").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    rows = sums.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("before", start + F.coalesce(running, F.lit(0)))
    return rows.where("before <= rest and rest < before + range_size").select(F.col("source").alias("end_source"), F.col("range").alias("end_range"), F.col("before").alias("end_before"))


def _plan(docs: DataFrame, seed: str, weights, most: int) -> tuple[DataFrame, DataFrame]:
    """(sizes and keys of all rows, one row for each source: target, whole epochs `full`, and the range of keys where the last one ends)."""
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), F.col("text"), seed).alias("key")))
    sums = cut(sized.groupBy("source", F.substring("key", 1, RANGE_DIGITS).alias("range")).agg(F.sum("size").alias("range_size")))
    plan = source_targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most)
    plan = plan.withColumn("budget", F.floor(F.col("target") + 0.5).cast("long"))
    plan = plan.withColumn("full", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("full") * F.col("source_size"))
    # one row for each source, as many as one task has ordered
    plan = cut(plan.withColumnRenamed("source", "plan_source").coalesce(1))
    with_ends = lambda ends: plan.join(ends, F.col("plan_source").eqNullSafe(F.col("end_source")), "left").drop("end_source").coalesce(1)
    wide = cut(with_ends(_ends(sums, plan, F.lit(0))))
    # the range in which the last, partial epoch ends, again by narrower ranges
    inside = _beside(sized, wide).where(F.substring("key", 1, RANGE_DIGITS) == F.col("end_range"))
    sums = inside.groupBy("source", F.substring("key", 1, 2 * RANGE_DIGITS).alias("range")).agg(F.sum("size").alias("range_size"))
    return sized, cut(with_ends(_ends(sums, wide.drop("end_range"), F.col("end_before"))))


def _beside(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of their source's plan."""
    return rows.join(F.broadcast(plan) if plan.count() <= MOST_BROADCAST else plan, F.col("source").eqNullSafe(F.col("plan_source")))


def _taken(rows: DataFrame, size: Column) -> DataFrame:
    """Rows with source, key and plan -> the same with `size` and `part`, the words that the last, partial epoch takes."""
    at = F.substring("key", 1, 2 * RANGE_DIGITS)
    inside = rows.where(at == F.col("end_range")).withColumn("size", size)
    running = F.coalesce(F.sum("size").over(W.partitionBy("source").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = inside.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("end_before") - running)).cast("long"))
    outside = rows.where(F.coalesce(at != F.col("end_range"), F.lit(True))).withColumn("size", size)
    return inside.unionByName(outside.withColumn("part", F.when(at < F.col("end_range"), F.col("size")).otherwise(0).cast("long")))


def mix(docs: DataFrame, seed: str = "mix-1", weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, full, part, taken."""
    sized, plan = _plan(docs, seed, weights, most)
    out = _taken(_beside(sized, plan), F.col("size"))
    return out.select("doc_id", "source", "size", "source_size", "target", "full", "part", (F.col("full") * F.col("size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """The mix itself, with the columns of the input: a row for each whole epoch, then the partial one.

    A document that the budget cuts keeps its first words; n_chars follows its text. Documents of which nothing is taken are not in the mix.
    Each row is decided where it stands: no row is joined to another, and only those around the ends of the budgets move.
    """
    _, plan = _plan(docs, seed, WEIGHTS, MOST)
    # one struct keeps the input's columns apart from the plan's
    rows = docs.select(F.col("source"), random_key(F.col("doc_id"), F.col("text"), seed).alias("key"), packed(docs))
    rows = _taken(_beside(rows, plan), word_count(F.col("_row")["text"]))
    copies = F.concat(
        F.array_repeat(F.col("size"), F.when(F.col("size") > 0, F.col("full")).otherwise(0).cast("int")),
        F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")),
    )
    rows = rows.select("_row", "size", F.explode(copies).alias("take"))
    text, whole = F.col("_row")["text"], F.col("take") >= F.col("size")
    words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("take").cast("int")), " ")
    rows = rows.withColumn("_text", F.when(whole, text).otherwise(words))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(whole, F.col("_row")["n_chars"]).otherwise(F.length("_text").cast("long"))
    return rows.select(*unpacked(docs, **changed))
