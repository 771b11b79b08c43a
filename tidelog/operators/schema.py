"""Table schemas: selection, projection, difference, policy, evolution."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import interval_seconds


@dataclass(frozen=True)
class TableSchema:
    name: str
    fields: T.StructType
    primary_key: str | None = None


def select_tables(explicit: list[str], include: list[str], exclude: list[str], found: list[str]) -> list[str]:
    """Globs over discovered names; explicit tables stay unless excluded. None at all is an error."""
    names = set(explicit) | {n for n in found if any(fnmatchcase(n, p) for p in include)}
    out = sorted(n for n in names if not any(fnmatchcase(n, p) for p in exclude))
    if not out:
        raise ValueError("no table selected")
    return out


def glob_like(name: Column, pattern: str) -> Column:
    """The same for a column; `*` matches a dot too."""
    special = "".join("\\" + c if c in r"\.+^$(){}|[]" else c for c in pattern)
    return name.rlike("^" + special.replace("*", ".*").replace("?", ".") + "$")


def selected(tables: DataFrame, name: str, include: list[str], exclude: list[str]) -> DataFrame:
    """The same over rows: names that match an included pattern and no excluded one."""
    any_of = lambda ps: F.lit(False) if not ps else _fold([glob_like(F.col(name), p) for p in ps])
    return tables.where(any_of(include) & ~any_of(exclude))


def _fold(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def resolve_key(keys: list[str], table: str) -> str:
    if len(keys) != 1:
        raise ValueError(f"{table}: {'no' if not keys else 'composite'} primary key")
    return keys[0]


def select_columns(columns: list[str], include: list[str], exclude: list[str], required: list[str]) -> list[str]:
    """Source order; required columns always stay and must be there."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return [c for c in columns if c in required or ((not include or c in include) and c not in exclude)]


def cast_projection(kinds: dict[str, str]) -> list[Column]:
    """How each logical type leaves the source."""
    out = []
    for name, kind in kinds.items():
        c = F.col(f"`{name}`")
        c = c.cast("string") if kind in ("string", "numeric") else F.to_json(c) if kind == "json" else interval_seconds(c.cast("string")) if kind == "interval" else c
        out.append(c.alias(name))
    return out


def with_metadata(schema: T.StructType, synced: str = "synced_at", deleted: str = "deleted_at") -> T.StructType:
    out = T.StructType(list(schema.fields))
    for name, nullable in ((synced, False), (deleted, True)):
        if name not in out.names:
            out = out.add(name, T.TimestampType(), nullable)
    return out


def diff(before: DataFrame, now: DataFrame) -> DataFrame:
    """Rows (name, data_type, nullable) of two schemas -> (name, change)."""
    a = before.select("name", F.col("data_type").alias("t0"), F.col("nullable").alias("n0"))
    b = now.select("name", F.col("data_type").alias("t1"), F.col("nullable").alias("n1"))
    change = F.when(F.col("t0").isNull(), "added").when(F.col("t1").isNull(), "removed").when(F.col("t0") != F.col("t1"), "type_changed").when(F.col("n0") != F.col("n1"), "nullable_changed")
    return a.join(b, "name", "full_outer").select("name", change.alias("change")).where("change is not null")


def check_policy(changes: list[tuple[str, str]], key_changed: bool, policy: str) -> None:
    bad = [c for c in changes if policy == "fail" or c[1] == "type_changed"]
    if bad or key_changed:
        raise ValueError(f"schema policy {policy}: {bad or 'primary key changed'}")


def stops(change: Column, policy: str) -> Column:
    """Does a change of a column stop the table: any does under `fail`, else a change of type."""
    return change.isNotNull() if policy == "fail" else F.coalesce(change == "type_changed", F.lit(False))


def key_changed_column(saved_key: Column, key: Column, saved_hash: Column, hash_now: Column, differs: Column) -> Column:
    """Has the primary key changed: the saved key tells; without one, a fingerprint that differs though no column does."""
    return F.when(saved_key.isNotNull(), saved_key != key).otherwise(F.coalesce((saved_hash != hash_now) & ~differs, F.lit(False)))


def fingerprint_column(name: Column, key: Column, columns: Column) -> Column:
    """Fingerprint of a table's name, key and columns (array of structs)."""
    return F.sha2(F.to_json(F.struct(name.alias("name"), key.alias("key"), columns.alias("columns"))), 256)


def key_changed(saved_key: str | None, saved_hash: str | None, schema: TableSchema, has_diff: bool) -> bool:
    if saved_key is not None:
        return saved_key != schema.primary_key
    return saved_hash is not None and saved_hash != fingerprint(schema) and not has_diff


def fingerprint(schema: TableSchema) -> str:
    fields = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]
    return hashlib.sha256(json.dumps([schema.name, schema.primary_key, fields]).encode()).hexdigest()


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old fields, then those of the new schema whose names, without case, are not there."""
    have = {f.name.lower() for f in old}
    return T.StructType([*old, *[T.StructField(f.name, f.dataType) for f in new if f.name.lower() not in have]])


def aligned(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in this schema's names, types and order; a column that they lack is NULL."""
    have = {c.lower(): c for c in rows.columns}
    of = lambda f: F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)
    return rows.select(*[of(f).cast(f.dataType).alias(f.name) for f in schema])


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Additive: columns new in either are NULL in the other, matched without case; none is dropped or retyped."""
    by_low = {c.lower(): c for c in old.columns}
    named = new.select(*[F.col(c).alias(by_low.get(c.lower(), c)) for c in new.columns])
    return old.unionByName(named, allowMissingColumns=True)
