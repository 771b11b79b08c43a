"""Embedding near-duplicates by int8 tile products with error bounds.

A unit vector x is kept as s * q + r, q its int8 components and e = |r|. For two of them
x.y <= s_x s_y (q_x.q_y) + e_x + e_y + e_x e_y, so a pair whose right side stays below the
threshold is surely no link; only the others are computed again in double precision. The int8 products are
exact: single precision multiplies as many components at a time as it can add up without rounding.

Equal vectors of one label are one node with a multiplicity. The nodes of a label are dealt
into tiles of about TILE, and each pair of tiles is a group of two rows, so neither a hot label
nor a group of copies meets in one task. Comparisons grow with the square of the distinct vectors
of a label, as the method's do; no pair of one label is skipped unseen.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
vectors without label, link with nothing (n_links 0, their own component); vectors of
different length link never; repeated rows are vectors each; rows without vec_id count as
links but name no component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_join
from .components import components
from .simhash import forest

THRESHOLD = 0.93
TILE = 4096
#: Far above the rounding of the double-precision bounds, and of a cosine.
_SLACK, _BORDER = 1e-9, 1e-12
#: Products of so many int8 components are whole numbers that single precision holds exactly.
_EXACT = (1 << 24) // (127 * 127)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of norm one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows -> int8 components, scales, and the norm of what they leave out."""
    s = np.abs(x).max(axis=1) / 127
    q = np.rint(x / s[:, None]).astype(np.int8)
    return q, s, np.linalg.norm(x - s[:, None] * q, axis=1) * (1 + 1e-12) + 1e-15


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows with int8 rows, by single-precision multiplication of as many components as it holds exactly."""
    parts = [a[:, k : k + _EXACT].astype(np.float32) @ b[:, k : k + _EXACT].astype(np.float32).T for k in range(0, a.shape[1], _EXACT)]
    return parts[0] if len(parts) == 1 else np.sum(parts, axis=0, dtype=np.float64)


def tile_links(x: np.ndarray, y: np.ndarray | None, threshold: float = THRESHOLD):
    """Yields arrays (i, j) of links between the rows of x and y, or inside x if y is None (i < j)."""
    same = y is None
    ux = unit(x)
    qx, sx, ex = quantise(ux)
    uy, qy, sy, ey = (ux, qx, sx, ex) if same else ((v := unit(y)), *quantise(v))
    worst, step = ey.max(), sy.astype(np.float32)
    # the product's rounding to single precision is far below one in 10^6 of 1
    need = ((threshold - ex - worst - ex * worst - _SLACK) / sx * (1 - 1e-6)).astype(np.float32)
    for a in range(0, len(x), 256):
        b = min(a + 256, len(x))
        near = int8_products(qx[a:b], qy) * step >= need[a:b, None]
        if same:
            near &= np.arange(len(x)) > np.arange(a, b)[:, None]
        i, j = np.nonzero(near)
        if len(i) > near.size // 20:
            # many at once; those that rounding could turn are decided below, one by one
            exact = ux[a:b] @ uy.T
            sure = near & (exact >= threshold + _BORDER)
            p, r = np.nonzero(sure)
            yield p + a, r
            i, j = np.nonzero(near & ~sure & (exact >= threshold - _BORDER))
        for k in range(0, len(i), 1 << 15):
            p, r = i[k : k + (1 << 15)] + a, j[k : k + (1 << 15)]
            ok = np.einsum("nd,nd->n", ux[p], uy[r]) >= threshold
            yield p[ok], r[ok]


def _pack(key, t):
    node, n = t["node"].to_numpy(), t["n"].to_numpy()
    flat = t["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8")
    return pa.table({"grp": t["grp"][:1], "tiles": t["tiles"][:1], "tile": t["tile"][:1], "nodes": pa.array([node.astype("<i8").tobytes()], pa.binary()), "copies": pa.array([n.astype("<i8").tobytes()], pa.binary()), "vectors": pa.array([flat.tobytes()], pa.binary())})


def _compare(t, threshold: float) -> pa.Table:
    rows = sorted(t.to_pylist(), key=lambda r: r["tile"])
    nodes = [np.frombuffer(r["nodes"], "<i8") for r in rows]
    copies = [np.frombuffer(r["copies"], "<i8") for r in rows]
    x = [np.frombuffer(r["vectors"], "<f8").reshape(len(n), -1) for r, n in zip(rows, nodes)]
    last = len(rows) - 1
    pair = rows[0]["pair"]
    empty = pa.table({"kind": pa.array([], pa.int32()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if last == 0 and pair // rows[0]["tiles"] != pair % rows[0]["tiles"]:
        return empty  # the other tile got no vector
    degree = [np.zeros(len(n), np.int64) for n in nodes]
    found = []
    for i, j in tile_links(x[0], x[1] if last else None, threshold):
        np.add.at(degree[0], i, copies[last][j])
        np.add.at(degree[last], j, copies[0][i])
        if len(i):
            found.append(forest(nodes[0][i], nodes[last][j]))
            if len(found) > 32:
                found = [forest(*(np.concatenate(z) for z in zip(*found)))]
    if not found:
        return empty
    a, b = forest(*(np.concatenate(z) for z in zip(*found)))
    ids, deg = (np.concatenate(z) for z in ([*nodes[: last + 1]], [*degree[: last + 1]]))
    ids, deg = ids[deg > 0], deg[deg > 0]
    kind = np.concatenate([np.zeros(len(a), np.int32), np.ones(len(ids), np.int32)])
    return pa.table({"kind": kind, "a": np.concatenate([a, ids]), "b": np.concatenate([b, deg])})


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.coalesce(F.col("label").isNotNull() & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = v.where(usable)
    nodes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
    grp = F.concat_ws(":", F.size("embedding").cast("string"), F.col("label").cast("string"))
    nodes = cut(nodes.withColumn("grp", grp).withColumn("node", F.coalesce("low", F.xxhash64("label", "embedding"))))
    sizes = nodes.groupBy("grp").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"), F.count("*").alias("_size"))
    dealt = spread_join(nodes, sizes, ["grp"], "_size", nodes.count()).withColumn("tile", F.pmod(F.xxhash64("node", "embedding"), F.col("tiles")).cast("int"))
    packed = cut(
        dealt.select("grp", "tiles", "tile", "node", "n", "embedding").groupBy("grp", "tile")
        .applyInArrow(_pack, "grp string, tiles int, tile int, nodes binary, copies binary, vectors binary")
    )
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.least("tile", j) * F.col("tiles") + F.greatest("tile", j))
    met = packed.withColumn("pair", F.explode(pairs)).groupBy("grp", "pair").applyInArrow(lambda key, t: _compare(t, threshold), "kind int, a long, b long")
    met = cut(met)
    degree = met.where("kind = 1").groupBy("a").agg(F.sum("b").alias("others"))
    comp = components(met.where("kind = 0").select("a", "b"))
    known = nodes.select("label", "embedding", "low", "n", "node")
    known = known.join(degree, known["node"] == degree["a"], "left").join(comp.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    known = cut(known.select("label", "embedding", "low", "n", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")))
    total, distinct = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("k"))
    known = spread_join(known, lowest, ["root"], "k", distinct).select("label", "embedding", "n", "n_links", "component_id")
    linked = spread_join(good, known, ["label", "embedding"], "n", total).select("vec_id", "n_links", "component_id")
    alone = v.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
