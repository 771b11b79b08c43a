"""What the operators of this subpackage share: tables, the shared folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once; bounds its arrays, not the work.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, it is an error but on one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not folder and not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = folder or "file://" + tempfile.mkdtemp(prefix="tidelog-")
        spark.sparkContext.setCheckpointDir(folder)
        current = folder
    return (folder or current).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Rows written once to the shared folder; later steps read them and survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Rows of a narrow table that one task writes when its lineage is cut, and tasks that share even a small one.
ROWS_A_TASK, LEAST_TASKS = 1_000_000, 8


def cut_narrow(df: DataFrame, rows: int) -> DataFrame:
    """`cut` of a narrow table of about so many rows, in as many files as they need and not one for each shuffle partition."""
    return cut(df.coalesce(max(LEAST_TASKS, rows // ROWS_A_TASK + 1)))


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh place under the shared folder, as a URI; it is deleted when the driver ends."""
    folder = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def local_path(uri: str) -> str:
    """A mounted path for Python's own file calls; other stores need a mount of the shared folder."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"the shared folder must be mounted on every node to hold binary shards: {uri}")
    return uri


#: A key is hot if it has more than one in so many of all rows; there are fewer hot keys than that.
HOT_SHARE = 1000


def spread_join(rows: DataFrame, side: DataFrame, key: list[str], n: str, total: int) -> DataFrame:
    """Rows joined to `side`, which has one row for each key and in `n` the number of rows with it.

    The hot keys' side, fewer than HOT_SHARE rows, is broadcast, so their rows stay where they are; the others meet by shuffle.
    """
    hot = F.col(n) * HOT_SHARE > total
    few = F.broadcast(side.where(hot).drop(n))
    rest = rows.join(few.select(*key), key, "left_anti").join(side.where(~hot).drop(n), key)
    return rows.join(few, key).unionByName(rest)


def spread_left_join(rows: DataFrame, side: DataFrame, key: Column, on: str, n: str, total: int) -> DataFrame:
    """Rows with the columns of `side` for their key (a 64-bit number), NULL where there is none; `side` is as for `spread_join`, its key `on`.

    Rows of hot keys, and rows without a key, stay or spread; the others meet their key's row by shuffle.
    """
    values, own = [c for c in side.columns if c not in (on, n)], rows.columns
    hot = F.col(n) * HOT_SHARE > total
    one = lambda k, where: side.where(where).select(F.col(on).alias(f"_on{k}"), F.struct(*values).alias(f"_v{k}"))
    rows = rows.withColumn("_key", key).join(F.broadcast(one(1, hot)), F.col("_key") == F.col("_on1"), "left")
    at = F.when(F.col("_key").isNotNull() & F.col("_on1").isNull(), F.col("_key")).otherwise(F.xxhash64(F.monotonically_increasing_id(), F.lit("none")))
    rows = rows.withColumn("_at", at).join(one(2, ~hot), F.col("_at") == F.col("_on2"), "left")
    found = F.coalesce(F.col("_v1"), F.when(F.col("_key") == F.col("_on2"), F.col("_v2")))
    return rows.withColumn("_v", found).select(*[F.col(f"`{c}`") for c in own], *[F.col("_v")[c].alias(c) for c in values])


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that an operator's own columns clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def unpacked(df: DataFrame, **changed: Column) -> list[Column]:
    """The columns of `df` from `_row`, those in `changed` replaced."""
    return [(changed[c] if c in changed else F.col("_row")[c]).alias(c) for c in df.columns]


def chunks(sizes, limit: int = CHUNK_BYTES):
    """Ranges of consecutive rows whose bytes stay near the limit; every row is in one range."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
