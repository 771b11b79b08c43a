"""SimHash near-duplicates by bit-sliced comparison.

Equal fingerprints are one node. Nodes meet where two of six bit blocks agree: within four
differing bits that always happens. In a bucket the fingerprints stand as 64 vertical bit
planes; one fingerprint against 64 lanes is an exclusive-or per plane, added into vertical
carry-save counters; comparisons whose lanes all exceed the radius are abandoned. A bucket
above TILE fingerprints is dealt out in pairs of tiles, so no task holds an unbounded one,
and each task returns a spanning forest of its links, never all pairs.

Defined results: null, empty and blank texts have fingerprint zero and link like any other;
repeated rows share a node; an empty table gives no rows; a row without doc_id takes the
component of its fingerprint (null if no row there has one).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, cut_narrow, packed, spread_join, spread_left_join, unpacked
from .components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Bits of the six blocks; RADIUS bits leave at least two of them whole.
BLOCKS = (11, 11, 11, 11, 10, 10)
TILE = 4096
#: Query-against-block comparisons that are held at once.
AT_ONCE = 1 << 15


def fingerprint(text: bytes) -> int:
    """Bit i is set where over half of the shingles' XXH64 have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    at = np.zeros(n + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=at[1:])
    starts, ends = at[: n - SHINGLE + 1].tolist(), (at[SHINGLE:] - 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        fp = np.array([fingerprint(v.as_py() or b"") for v in text], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])


def bit_planes(lanes: np.ndarray) -> np.ndarray:
    """(blocks, 64 lanes) -> (64 planes, blocks): bit l of plane b is bit b of lane l."""
    bits = np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.transpose(2, 0, 1)), axis=2, bitorder="little").view(np.uint64)[..., 0]


def within(planes: np.ndarray, block: np.ndarray, query: np.ndarray, valid: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each (query, block): the lanes at most `radius` bits away, as a mask.

    Counters c0..c2 hold a vertical sum up to 7; `over` keeps lanes that have left the radius.
    """
    out = np.zeros(len(query), np.uint64)
    live, over = np.arange(len(query)), ~valid
    c = [np.zeros(len(query), np.uint64) for _ in range(3)]
    full, one = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1)
    for b in range(64):
        carry = planes[b][block[live]] ^ (np.uint64(0) - (query[live] >> np.uint64(b) & one))
        for k in range(3):
            carry, c[k] = c[k] & carry, c[k] ^ carry
        over |= carry
        # over once the count is radius + 1: with radius 4 that is 101, 110 or 111
        over |= c[2] & (c[0] | c[1]) if radius == 4 else _above(c, radius)
        if b % 4 == 3:
            keep = over != full
            if not keep.all():
                live, over, c = live[keep], over[keep], [x[keep] for x in c]
            if not len(live):
                return out
    out[live] = ~over
    return out


def _above(c: list[np.ndarray], radius: int) -> np.ndarray:
    hit = np.zeros_like(c[0])
    for v in range(radius + 1, 8):
        m = np.full_like(c[0], np.uint64(0xFFFFFFFFFFFFFFFF))
        for k in range(3):
            m &= c[k] if v >> k & 1 else ~c[k]
        hit |= m
    return hit


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links -> as few links with the same components: each node to its smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            break
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def bucket_links(fps: np.ndarray, group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest of links inside each group (sorted by group).

    side 0 and 1: only pairs across the two sides; side 2: all pairs of the group.
    """
    cuts = np.flatnonzero(np.diff(group)) + 1
    begin, stop = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fps)]])
    size = stop - begin
    begin, size = begin[size > 1], size[size > 1]
    if not len(begin):
        return fps[:0], fps[:0]
    n_blocks = -(-size // 64)
    first_block = np.concatenate([[0], np.cumsum(n_blocks)[:-1]])
    g_of_block = np.repeat(np.arange(len(begin)), n_blocks)
    k_of_block = np.arange(len(g_of_block)) - first_block[g_of_block]
    at = (begin[g_of_block] + 64 * k_of_block)[:, None] + np.arange(64)
    real = at < (begin + size)[g_of_block][:, None]
    at = np.where(real, at, 0)
    planes = bit_planes(np.where(real, fps[at], np.uint64(0)))
    lane_bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    valid = (real * lane_bit).sum(axis=1, dtype=np.uint64)
    other = [(((side[at] != s) & real) * lane_bit).sum(axis=1, dtype=np.uint64) for s in (0, 1)]
    # a member meets its own block and the later ones
    g_of_row = np.repeat(np.arange(len(begin)), size)
    row = np.arange(len(g_of_row)) - np.concatenate([[0], np.cumsum(size)[:-1]])[g_of_row]
    todo = n_blocks[g_of_row] - row // 64
    upto, found = np.cumsum(todo), []
    lo = 0
    while lo < len(row):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + AT_ONCE, "right")))
        r = np.repeat(np.arange(lo, hi), todo[lo:hi])
        step = np.arange(len(r)) - np.repeat(np.concatenate([[0], np.cumsum(todo[lo:hi])[:-1]]), todo[lo:hi])
        own = row[r] // 64
        block = first_block[g_of_row[r]] + own + step
        me = begin[g_of_row[r]] + row[r]
        ok = valid[block]
        s = side[me]
        ok = np.where(s == 0, other[0][block], np.where(s == 1, other[1][block], ok))
        later = np.uint64(0xFFFFFFFFFFFFFFFE) << (row[r] % 64).astype(np.uint64)
        ok = np.where(step == 0, ok & later, ok)
        mask = within(planes, block, fps[me], ok)
        hit = np.flatnonzero(mask)
        if len(hit):
            bits = np.unpackbits(mask[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, lane = np.nonzero(bits)
            found.append(forest(fps[me[hit[i]]], fps[at[block[hit[i]], lane]]))
            if len(found) > 16:
                found = [forest(*(np.concatenate(x) for x in zip(*found)))]
        lo = hi
    if not found:
        return fps[:0], fps[:0]
    return forest(*(np.concatenate(x) for x in zip(*found)))


def _bucket_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group; whole groups are compared, some tens of thousands of rows at a time."""
    rest: list[np.ndarray] = []

    def flush(cols):
        a, b = bucket_links(cols[2].view(np.uint64), cols[0] * np.int64(1_000_003) + cols[1], cols[3])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("bucket", "tile", "fp", "side")]
        rest = [np.concatenate(x) for x in zip(rest, cols)] if rest else cols
        new = (np.diff(rest[0]) != 0) | (np.diff(rest[1]) != 0)
        at = np.flatnonzero(new)
        if len(at):
            k = int(at[-1]) + 1
            yield flush([x[:k] for x in rest])
            rest = [x[k:] for x in rest]
    if rest and len(rest[0]):
        yield flush(rest)


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, fp): one row for each pair of blocks."""
    shift, parts = 0, []
    for width in BLOCKS:
        parts.append((shift, width))
        shift += width
    keys = []
    for i, (x, y) in enumerate(combinations(parts, 2)):
        piece = lambda p: F.shiftrightunsigned("fp", p[0]).bitwiseAND((1 << p[1]) - 1)
        keys.append((F.lit(i << 22).cast("long") + F.shiftleft(piece(x), y[1]) + piece(y)).cast("long"))
    return nodes.select("fp", F.explode(F.array(*keys)).alias("bucket"))


def links(nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) with the components of all pairs within the radius."""
    rows = _buckets(nodes)
    hot = rows.groupBy(F.col("bucket").alias("hot_bucket")).agg(F.count("*").alias("n")).where(F.col("n") > tile)
    hot = hot.withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    rows = spread_left_join(rows, hot, F.col("bucket"), "hot_bucket", "n", nodes.count() * len(list(combinations(BLOCKS, 2))))
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda j: F.struct(
            (F.least(mine, j) * F.col("tiles") + F.greatest(mine, j)).alias("tile"),
            F.when(j == mine, 2).when(mine < j, 0).otherwise(1).alias("side"),
        ),
    )
    whole = F.array(F.struct(F.lit(0).alias("tile"), F.lit(2).alias("side")))
    rows = rows.select("bucket", "fp", F.explode(F.when(F.col("tiles").isNull(), whole).otherwise(pair)).alias("t"))
    rows = rows.select("bucket", F.col("t.tile").cast("long").alias("tile"), "fp", F.col("t.side").cast("long").alias("side"))
    return rows.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile").mapInArrow(_bucket_task, "a long, b long")


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, fp), the same with root and component_id, and (_fp, root, component_id) of every fingerprint."""
    prints = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_fingerprints, "doc_id long, fp long")
    prints = cut(prints)
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")))
    comp = components(links(nodes.select("fp")))
    linked = nodes.join(comp, nodes["fp"] == comp["node"])
    lowest = linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("k"))
    distinct, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    by_fp = spread_join(comp, lowest, ["root"], "k", distinct).select(F.col("node").alias("fp"), "root", "component_id")
    by_fp = nodes.join(by_fp, "fp", "left").select("fp", "n", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "low").alias("component_id"))
    by_fp = cut_narrow(by_fp, distinct)
    return prints, spread_join(prints, by_fp, ["fp"], "n", total), by_fp.select(F.col("fp").alias("_fp"), "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest doc_id reachable)."""
    return _linked(docs)[1].select("doc_id", "fp", "component_id")


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of each component, once each, with all their columns.

    Rows of one doc_id with different texts all stay if that id stays. A row without doc_id has its text's hash
    for an identity: one such row stays of each component in which no row has an id.
    """
    _, near, by_fp = _linked(docs)
    kept = near.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_id"), F.lit(None).cast("long").alias("_of")).distinct()
    bare = docs.where(F.col("doc_id").cast("long").isNull())
    if bare.head(1):
        bare = bare.select(F.xxhash64("text").alias("doc_id"), F.col("text").cast("string")).mapInArrow(_fingerprints, "doc_id long, fp long")
        bare = bare.join(by_fp.where("component_id IS NULL"), F.col("fp") == F.col("_fp")).groupBy("root").agg(F.min("doc_id").alias("_of"))
        kept = kept.unionByName(bare.select(F.lit(None).cast("long").alias("_id"), "_of"))
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_h"), packed(docs))
    of = F.when(rows["_doc"].isNull(), rows["_h"])
    rows = rows.join(kept, rows["_doc"].eqNullSafe(kept["_id"]) & of.eqNullSafe(kept["_of"]), "left_semi")
    first = F.row_number().over(W.partitionBy("_doc", "_h").orderBy("_h"))
    return rows.withColumn("_n", first).where("_n = 1").select(*unpacked(docs))
