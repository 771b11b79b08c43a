"""Items of typed attributes, exports and change records."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import lenient


def _plain(v: dict):
    """One attribute value; an unknown type is null."""
    for kind, read in (
        ("S", str), ("N", str), ("BOOL", bool), ("NULL", lambda x: None), ("B", str), ("SS", list), ("NS", list), ("BS", list),
        ("M", lambda m: {k: _plain(x) for k, x in m.items()}), ("L", lambda xs: [_plain(x) for x in xs]),
    ):
        if kind in v:
            return read(v[kind])
    return None


def decode_item(text: str | None) -> str | None:
    if text is None:
        return None
    return json.dumps({k: _plain(v) for k, v in json.loads(text).items()}, separators=(",", ":"), sort_keys=True, ensure_ascii=False)


_SCALARS = "map<string,struct<S:string,N:string,BOOL:boolean,NULL:boolean,B:string,SS:array<string>,NS:array<string>,BS:array<string>>>"


def _flat(item: Column) -> Column:
    """Attributes without nesting as plain JSON, names in order."""
    quoted = lambda x: F.substr(F.to_json(F.array(x)), F.lit(2), F.length(F.to_json(F.array(x))) - 2)

    def value(v):
        out = F.when(v["S"].isNotNull(), quoted(v["S"])).when(v["N"].isNotNull(), quoted(v["N"])).when(v["BOOL"].isNotNull(), v["BOOL"].cast("string")).when(v["NULL"].isNotNull(), "null")
        out = out.when(v["B"].isNotNull(), quoted(v["B"]))
        for k in ("SS", "NS", "BS"):
            out = out.when(v[k].isNotNull(), F.to_json(v[k]))
        return out.otherwise("null")

    entries = F.array_sort(F.map_entries(F.from_json(item, _SCALARS)))
    return F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(":"), value(e["value"]))), ","), F.lit("}"))


def decoded(item: Column) -> Column:
    """A map of typed attributes as plain JSON. Nested ones, of any depth, go through an Arrow-batched UDF, the others through expressions."""

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(decode_item, na_action="ignore")

    # backslashes mark escapes, which the two writers of JSON spell differently
    nested = item.rlike(r'"[ML]"\s*:|\\')
    return F.when(nested, decode(F.when(nested, item))).otherwise(_flat(item))


def flat_attribute(item: Column, name: str) -> Column:
    """A scalar attribute without Python."""
    return F.coalesce(*[F.get_json_object(item, f"$.{name}.{k}") for k in ("S", "N", "BOOL", "B")])


def typed(records: DataFrame, item: str, attributes: dict[str, str]) -> DataFrame:
    """Declared attributes by type (missing or unreadable: NULL), the raw item, event_at and event_id."""
    cols = [lenient(F.get_json_object(item, f"$.{a}"), t).alias(a) for a, t in attributes.items()]
    return records.select(*cols, F.col(item).alias("raw_item"), "event_at", "event_id")


def records_frame(records: DataFrame, item: str, schema: dict[str, str]) -> DataFrame:
    return records.select(*[lenient(F.get_json_object(item, f"$.{a}"), t).alias(a) for a, t in schema.items()])


def read_export(spark, path: str) -> DataFrame:
    """Lines {"Item": {...}} of an export, gzip or not."""
    return spark.read.text(path).where(F.length("value") > 0).select(F.get_json_object("value", "$.Item").alias("item"))


def change_records(records: DataFrame, now_s: float | None = None, cutoff_ms: int | None = None) -> DataFrame:
    """(shard, position, arrival_ms, body) -> op, event_at_s, event_id, item, deleted_at_s.

    A removal takes its old image, others their new one, both the keys if there is none; a record without a name or an image is
    an error. A record is as old as its payload says, else its envelope, else it is of now; it arrived then if no arrival is
    known. With a cutoff, each shard stops at its first record that arrived later.
    """
    part = lambda path: F.get_json_object("body", path)
    name = part("$.eventName")
    name = F.when(F.assert_true(name.isNotNull() | F.col("body").isNull(), "a change record lacks eventName").isNull(), name)
    at = F.coalesce(part("$.dynamodb.ApproximateCreationDateTime").try_cast("double"), part("$.approximateCreationDateTime").try_cast("double"), F.unix_micros(F.current_timestamp()) / 1e6 if now_s is None else F.lit(float(now_s)))
    r = records.withColumns({"_name": name, "_at": at})
    if cutoff_ms is not None:
        arrived = F.coalesce(F.col("arrival_ms"), F.col("_at") * 1000)
        late = F.max((arrived > cutoff_ms).cast("int")).over(W.partitionBy("shard").orderBy("position"))
        r = r.withColumn("_late", late).where("_late = 0")
    removed = F.col("_name") == "REMOVE"
    image = lambda k: F.when(part(f"$.dynamodb.{k}").startswith("{"), part(f"$.dynamodb.{k}"))
    item = F.when(removed, F.coalesce(image("OldImage"), image("Keys"))).otherwise(F.coalesce(image("NewImage"), image("Keys")))
    item = F.when(F.assert_true(item.isNotNull(), "a change record lacks its image").isNull(), item)
    return r.select(
        F.when(removed, "delete").otherwise("upsert").alias("op"), F.col("_at").alias("event_at_s"), F.concat_ws(":", "shard", "position").alias("event_id"),
        item.alias("item"), F.when(removed, F.col("_at")).alias("deleted_at_s"),
    )


def read_jdbc(spark, url: str, table: str, pk: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A table split by key range; columns and filters go to the source."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=pk, lowerBound=low, upperBound=high, numPartitions=parts, **options).load()
