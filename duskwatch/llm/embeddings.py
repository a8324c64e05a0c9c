"""Operator 5: near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned into the basis of principal components, strongest first. Within a label they are put into tiles
along the first component; two tiles whose ranges on it lie further apart than a link allows are never compared. For a pair of
tiles, products are accumulated over leading dimensions; what is missing is at most the product of the suffix norms, and pairs that cannot reach
the threshold any more are dropped on the way. Survivors are computed in full in double precision. Equal vectors are one class, counted
once, so copies are never multiplied out; the basis only decides how early a pair is dropped, never whether it links.

The number of tile pairs grows with the square of the largest label, as an exact comparison within labels must; one task holds two tiles at a time.

Defined cases: vectors that are null, zero or hold null or non-finite components, and vectors without a label, link with nothing and are
components of their own; vectors of different length never link; repeated rows are separate vectors; a null vec_id counts as a vector, and
component_id is the smallest that is not null; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.components import components
from duskwatch.llm.tables import settle

TILE = 2048
CELLS = 4096  # steps of the first component that tiles are cut at
SLACK = 1e-9  # above every rounding error of the bounds
_CHUNK = 1 << 17


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_basis(classes: DataFrame) -> tuple[int, np.ndarray]:
    """(length of most vectors, its basis as columns): second moments summed over all vectors of that length."""
    most = classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not most:
        return 0, np.zeros((0, 0))
    dim = most[0]["dim"]

    def moments(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                x = _unit(batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["at", "value"])

    summed = (classes.where(F.col("dim") == dim).select("embedding").mapInArrow(moments, "at bigint, value double")
              .groupBy("at").agg(F.sum("value").alias("value")).collect())  # dim x dim numbers
    second = np.zeros(dim * dim)
    for r in summed:
        second[r["at"]] = r["value"]
    values, vectors = np.linalg.eigh(second.reshape(dim, dim))
    return dim, vectors[:, ::-1].copy()


def _link_tiles(x: np.ndarray, y: np.ndarray, same: bool, turn: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of unit vectors x and y whose cosine reaches the threshold; i < j if both are one tile."""
    a, b = (x, y) if turn is None else (x @ turn, y @ turn)
    dim = a.shape[1]
    stops = sorted({min(dim, s) for s in (8, 16, 32, 64, 128, 256, 512)} | {dim})
    suffix = lambda m, k: np.sqrt(np.maximum(0, (m[:, k:] ** 2).sum(1)))
    total = a[:, :stops[0]] @ b[:, :stops[0]].T
    alive = total + np.outer(suffix(a, stops[0]), suffix(b, stops[0])) >= threshold - SLACK
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    sums = total[i, j]
    del total, alive
    for lo, hi in zip(stops, stops[1:]):
        sa, sb = suffix(a, hi), suffix(b, hi)
        keep = []
        for at in range(0, len(i), _CHUNK):
            p, q = i[at:at + _CHUNK], j[at:at + _CHUNK]
            sums[at:at + _CHUNK] += np.einsum("ij,ij->i", a[p, lo:hi], b[q, lo:hi])
            keep.append(sums[at:at + _CHUNK] + sa[p] * sb[q] >= threshold - SLACK)
        if keep:
            keep = np.concatenate(keep)
            i, j, sums = i[keep], j[keep], sums[keep]
    exact = [np.einsum("ij,ij->i", x[i[at:at + _CHUNK]], y[j[at:at + _CHUNK]]) >= threshold for at in range(0, len(i), _CHUNK)]
    if exact:
        exact = np.concatenate(exact)
        i, j = i[exact], j[exact]
    return i, j


def _hubs(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest id of its component over links i-j."""
    label = ids.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        if (label == before).all():
            return label


def tile_links(tiles: DataFrame, pairs: DataFrame, threshold: float, basis: tuple[int, np.ndarray]) -> DataFrame:
    """(cid, links, hub): per pair of tiles and class in it, how many vectors of the other it links, and its local component's first class."""
    side = lambda name: tiles.select("label", "dim", F.col("tile").alias(name), F.col("rows").alias(f"rows_{name}"))
    work = pairs.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"]).select("dim", "a", "b", "rows_a", "rows_b")
    at, turn = basis

    def read(rows, dim):
        fields = rows.values
        ids, n = fields.field("cid").to_numpy(), fields.field("n").to_numpy()
        return ids, n, _unit(fields.field("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                dim, a, b = (batch.column(c)[k].as_py() for c in ("dim", "a", "b"))
                ids, n, x = read(batch.column("rows_a")[k], dim)
                ids_b, n_b, y = read(batch.column("rows_b")[k], dim)
                i, j = _link_tiles(x, y, a == b, turn if dim == at else None, threshold)
                if not len(i):
                    continue
                if a != b:
                    j = j + len(ids)
                    ids, n = np.concatenate([ids, ids_b]), np.concatenate([n, n_b])
                links = np.bincount(i, n[j], len(ids)) + np.bincount(j, n[i], len(ids))
                hub = _hubs(len(ids), i, j, ids)
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(links[hit].astype(np.int64)), pa.array(hub[hit])],
                                                 ["cid", "links", "hub"])

    return work.mapInArrow(run, "cid bigint, links bigint, hub bigint")


def link_vectors(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    rows = vectors.select(F.col("vec_id").cast("bigint"), "label", "embedding")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    sound = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    classes = settle(
        rows.where(sound).groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
        .withColumn("dim", F.size("embedding")).withColumn("cid", F.monotonically_increasing_id()), "classes")
    dim, turn = principal_basis(classes)

    def first_component(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            values = batch.column("embedding")
            flat, ends = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(dims)
            y = np.zeros(len(dims))
            own = dims == dim
            if own.any():
                places = (ends - dims)[own][:, None] + np.arange(dim)
                y[own] = _unit(flat[places]) @ turn[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(y)], ["cid", "y"])

    placed = classes.select("cid", "dim", "embedding").mapInArrow(first_component, "cid bigint, y double")
    cell = F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), F.floor((F.col("y") + 1) * (CELLS / 2)))).cast("int")
    placed = settle(classes.join(placed, "cid").withColumn("cell", cell), "placed")
    before = Window.partitionBy("label", "dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most CELLS rows
    cells = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("rows")).select(
        "label", "dim", "cell", F.floor(F.coalesce(F.sum("rows").over(before), F.lit(0)) / tile).alias("tile"),
        F.ceil(F.col("rows") / tile).alias("parts"))
    # a cell of more rows than a tile holds is dealt to several tiles
    tiles = settle(
        placed.join(cells, ["label", "dim", "cell"])
        .withColumn("tile", F.col("tile") + F.pmod(F.xxhash64("cid"), F.col("parts")))
        .groupBy("label", "dim", "tile").agg(F.min("y").alias("lo"), F.max("y").alias("hi"),
                                             F.collect_list(F.struct("cid", "n", "embedding")).alias("rows")), "tiles")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    ranges = tiles.select("label", "dim", "tile", "lo", "hi")
    other = ranges.select("label", "dim", F.col("tile").alias("b"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    pairs = ranges.withColumnRenamed("tile", "a").join(other, ["label", "dim"]).where(
        (F.col("a") <= F.col("b")) & (F.col("b_lo") - F.col("hi") <= reach) & (F.col("lo") - F.col("b_hi") <= reach)
    ).select("label", "dim", "a", "b")
    found = settle(tile_links(tiles, pairs, threshold, (dim, turn)), "links")
    degrees = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found, "cid", "hub").withColumnRenamed("node", "cid")
    numbered = classes.join(degrees, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    firsts = numbered.groupBy("root").agg(F.min("first").alias("component_id"))
    known = settle(numbered.join(firsts, "root").select(
        F.col("label").alias("_label"), F.col("embedding").alias("_embedding"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "known")
    sound_rows = rows.where(sound).join(known, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")))
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return sound_rows.select("vec_id", "n_links", "component_id").unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
