"""Versioned Parquet tables in hash buckets, sinks, and a lease."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.merge import upsert
from .operators.schema import aligned, widened

#: How many names of applied batches a version remembers; a stream repeats its last one only.
REMEMBERED = 32


class Files:
    """The few file calls of a table, by Hadoop's file system: any store that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8
        self.io = jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.io.toString(stream, self.utf8)
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Whole or not at all; an error if the file is there already."""
        aside = self.path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(aside, False)
        try:
            self.io.write(text, stream, self.utf8)
        finally:
            stream.close()
        if not self._place(aside, self.path(path)):
            self.fs.delete(aside, False)
            raise FileExistsError(f"another writer made {path}")

    def _place(self, aside, target) -> bool:
        """A distributed file system's rename never replaces a file; a local one's does, but its links don't."""
        if self.fs.getScheme() != "file":
            return not self.fs.exists(target) and self.fs.rename(aside, target)
        at = lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
        try:
            self.jvm.java.nio.file.Files.createLink(at(target), at(aside))
        except Py4JJavaError:
            return False
        self.fs.delete(aside, False)
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


#: Types by which a warehouse clusters a table.
CLUSTERED = ("string", "bigint", "int", "boolean", "timestamp", "timestamp_ntz", "date", "binary")


def layout(schema: T.StructType, pk: str | None, synced: str | None = None) -> list[Column]:
    """How rows are sorted in files: by the day they were synced, where that is wanted, then by the key, if its type allows."""
    kind = schema[pk].dataType.simpleString() if pk and pk in schema.names else ""
    days = [F.to_date(synced)] if synced and synced in schema.names else []
    return days + ([F.col(pk)] if kind in CLUSTERED or kind.startswith("decimal") else [])


class VersionedTable:
    """A table as numbered manifests over immutable folders; readers never see half a write.

    Rows with a key lie in `buckets` hash buckets. An append adds folders; an upsert reads and
    rewrites only the buckets that its rows fall into, so its cost follows the batch and not the
    table. A manifest holds the schema (columns are only ever added; older files read as NULL), the
    folders of each bucket and the names of the last batches; a repeated batch is no new version.
    Two writers cannot make one version: the second gets a FileExistsError.
    Files are sorted by the day of `by_day` and the key, for pruning by their minima and maxima.
    """

    def __init__(self, spark: SparkSession, root: str, pk: str | None = None, by_day: str | None = None, buckets: int = 64):
        self.spark, self.root, self.pk, self.by_day = spark, root.rstrip("/"), pk, by_day
        self.buckets = buckets if pk else 1
        self.files = Files(spark, self.root)

    def version(self) -> int | None:
        made = [int(n[:-5]) for n in self.files.names(f"{self.root}/manifests") if n.endswith(".json")]
        return max(made, default=None)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version is None:
            return {"version": 0, "schema": None, "buckets": self.buckets, "parts": {}, "names": []}
        return json.loads(self.files.read(f"{self.root}/manifests/{version:012d}.json"))

    def _commit(self, m: dict, schema: T.StructType, parts: dict[str, list[str]], name: str | None) -> int:
        names = [*m["names"], name][-REMEMBERED:] if name else m["names"]
        new = {"version": m["version"] + 1, "schema": json.loads(schema.json()), "buckets": m["buckets"], "parts": parts, "names": names}
        self.files.create(f"{self.root}/manifests/{new['version']:012d}.json", json.dumps(new))
        return new["version"]

    def _schema(self, m: dict) -> T.StructType | None:
        return T.StructType.fromJson(m["schema"]) if m["schema"] else None

    def _rows(self, m: dict, buckets: set[str] | None = None) -> DataFrame:
        paths = [f"{self.root}/{p}" for b, ps in m["parts"].items() if buckets is None or b in buckets for p in ps]
        schema = self._schema(m)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self, rows: DataFrame, n: int) -> Column:
        """Rows without a key spread by their content, since no merge looks for them."""
        if not self.pk:
            return F.lit(0)
        plain = [f.name for f in rows.schema if isinstance(f.dataType, T.AtomicType)]
        return F.pmod(F.when(F.col(self.pk).isNotNull(), F.xxhash64(self.pk)).otherwise(F.xxhash64(*plain)), F.lit(n)).cast("int")

    def _write(self, rows: DataFrame, n: int) -> dict[str, list[str]]:
        """Rows in a new folder, split by bucket; adaptive execution splits large buckets and joins small ones."""
        folder = f"data/{uuid.uuid4().hex}"
        out = rows.withColumn("_bucket", self._bucket(rows, n))
        out = out.hint("rebalance", "_bucket") if self.pk else out.hint("rebalance")
        out.sortWithinPartitions("_bucket", *layout(rows.schema, self.pk, self.by_day)).write.option("compression", "snappy").partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        made = [n for n in self.files.names(f"{self.root}/{folder}") if n.startswith("_bucket=")]
        return {n.split("=")[1]: [f"{folder}/{n}"] for n in made}

    def ensure(self, schema: T.StructType) -> None:
        """Creates the table, or adds missing columns; existing ones stay as they are. No data is written."""
        m = self.manifest()
        old = self._schema(m)
        new = schema if old is None else widened(old, schema)
        if old is None or len(new) > len(old):
            self._commit(m, new, m["parts"], None)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.manifest(version))

    def append(self, rows: DataFrame, name: str | None = None) -> int:
        """Adds folders; nothing that is there is read or written."""
        m = self.manifest()
        if name and name in m["names"]:
            return m["version"]
        schema = widened(self._schema(m) or T.StructType(), rows.schema)
        new = self._write(aligned(rows, schema), m["buckets"])
        return self._commit(m, schema, {b: m["parts"].get(b, []) + new.get(b, []) for b in {**m["parts"], **new}}, name)

    def write_batch(
        self, rows: DataFrame, mode: str = "upsert", name: str | None = None, truncate_first: bool = False,
        merge: Callable[[DataFrame, DataFrame, str], DataFrame] = upsert,
    ) -> int:
        """Merges by key, or appends if there is none; a truncate before it is part of the same version.

        `merge(target, source, pk)` sees the touched buckets alone, so it must look at equal keys only.
        """
        m = self.manifest()
        if name and name in m["names"]:
            return m["version"]
        if (mode == "append" or self.pk is None) and not truncate_first:
            return self.append(rows, name)
        schema = widened(self._schema(m) or T.StructType(), rows.schema)
        if truncate_first:
            m = {**m, "parts": {}}
        source = self.stage(aligned(rows, schema), name or uuid.uuid4().hex)
        if mode == "append" or self.pk is None:
            return self._commit(m, schema, self._write(source, m["buckets"]), name)
        # at most one row for each bucket reaches the driver
        touched = {str(r[0]) for r in source.select(self._bucket(source, m["buckets"])).distinct().collect()}
        target = aligned(self._rows(m, touched), schema) if m["schema"] else self.spark.createDataFrame([], schema)
        new = self._write(merge(target, source, self.pk), m["buckets"])
        kept = {b: ps for b, ps in m["parts"].items() if b not in touched}
        for b, ps in new.items():
            kept[b] = kept.get(b, []) + ps
        return self._commit(m, schema, kept, name)

    def compact(self, most: int = 8) -> int | None:
        """Rewrites the buckets of more than `most` folders, which appends leave behind."""
        m = self.manifest()
        many = {b for b, ps in m["parts"].items() if len(ps) > most}
        if not many:
            return self.version()
        new = self._write(self._rows(m, many), m["buckets"])
        kept = {b: ps for b, ps in m["parts"].items() if b not in many}
        for b, ps in new.items():
            kept[b] = kept.get(b, []) + ps
        return self._commit(m, self._schema(m), kept, None)

    def truncate(self) -> int:
        m = self.manifest()
        return self._commit(m, self._schema(m), {}, None)

    def expire(self, keep: int = 10) -> None:
        """Deletes all but the last `keep` versions and the folders that only they use. No writer may be at work."""
        last = self.version() or 0
        used = {p.split("/")[1] for v in range(max(1, last - keep + 1), last + 1) for ps in self.manifest(v)["parts"].values() for p in ps}
        for n in self.files.names(f"{self.root}/manifests"):
            if n.endswith(".json") and int(n[:-5]) <= last - keep:
                self.files.delete(f"{self.root}/manifests/{n}")
        for n in self.files.names(f"{self.root}/data"):
            if n not in used:
                self.files.delete(f"{self.root}/data/{n}")

    def stage(self, rows: DataFrame, job_id: str) -> DataFrame:
        """Rows at the place of their job, overwritten by a retry."""
        path = f"{self.root}/staging/{job_id}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def strict(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Casts that fail on bad values, and an error for a missing column, before an encode."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    out = []
    for f in schema:
        c = F.col(f.name).cast(f.dataType) if f.dataType == df.schema[f.name].dataType else F.col(f.name).try_cast(f.dataType)
        bad = F.col(f.name).isNotNull() & c.isNull()
        out.append(F.when(F.assert_true(~bad, f"bad value in {f.name}").isNull(), c).alias(f.name))
    return df.select(*out)


def json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"))


class Lease:
    """One owner per name; a lease not renewed for ttl seconds may be taken over.

    A lease is a row of numbered files; who makes the next one holds it, and only one can. The file system is Hadoop's.
    """

    def __init__(self, spark: SparkSession, folder: str, ttl: float = 60.0):
        self.folder, self.ttl, self.files = folder.rstrip("/"), ttl, Files(spark, folder)

    def _held(self, name: str) -> tuple[int, dict | None]:
        made = [n for n in self.files.names(f"{self.folder}/{name}") if n.endswith(".json")]
        if not made:
            return 0, None
        return int(made[-1][:-5]), json.loads(self.files.read(f"{self.folder}/{name}/{made[-1]}"))

    def _next(self, name: str, number: int, owner: str | None, now: float) -> bool:
        try:
            self.files.create(f"{self.folder}/{name}/{number + 1:012d}.json", json.dumps({"owner": owner, "at": now}))
        except FileExistsError:
            return False
        for n in self.files.names(f"{self.folder}/{name}"):
            if n.endswith(".json") and int(n[:-5]) < number:
                self.files.delete(f"{self.folder}/{name}/{n}")
        return True

    def acquire(self, name: str, owner: str, now: float | None = None) -> bool:
        """Also renews the owner's own."""
        now = time.time() if now is None else now
        number, held = self._held(name)
        if held and held["owner"] not in (None, owner) and now - held["at"] < self.ttl:
            return False
        return self._next(name, number, owner, now)

    def release(self, name: str, owner: str) -> None:
        number, held = self._held(name)
        if held and held["owner"] == owner:
            self._next(name, number, None, held["at"])
