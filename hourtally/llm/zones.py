"""Centroid clustering over zone maps along a space-filling curve.

Vectors of ``DIMENSIONS`` whole-numbered components are ordered along a Hilbert curve and cut into blocks
of ``BLOCK`` neighbours, each with the least and the greatest value of every component. A centroid that is
farther from every point of a block's box than one other centroid cannot be nearest to any vector of
the block; what is left are the block's candidates, which all its vectors are compared with at once,
exactly. Only sums and counts for each centroid and task leave a round; vectors are never moved again.

The first centroids are the vectors of the smallest hashes of their ids. Every round assigns all vectors and replaces
each centroid that has any by the floor of their mean, component by component. Equal distances go to the smaller number,
and nothing depends on the order of addition.

A vector that is null, of another length, or holds a null or a component that is not finite is left out of the result.
A null id takes part; as a first centroid it comes after all others. Repeated ids are vectors of their own; as
first centroids they are ordered by their components. With fewer vectors than centroids there are as many centroids as
vectors, without vectors no rows. Components of 2**14 or more are computed with whole numbers of any length; a
distance or sum beyond a long is shown as the largest long. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtally.llm import stored

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
# Vectors of one block, and bits of each component that the curve tells apart.
BLOCK = 64
BITS = 4
# Below this, squared distances of whole numbers are exact as doubles.
NARROW = 1 << 22
# Sums of one centroid are added up in so many parts first.
SALTS = 64
LARGEST = (1 << 63) - 1

KEYED = "vec_id long, x array<double>, key binary"
BLOCKS = "ids array<long>, wide boolean, held binary, low binary, high binary"
ASSIGNED = "vec_id long, cluster int, distance long"
SUMS = "cluster int, salt int, n long, sums array<string>"


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, x`` of the vectors that can be clustered."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    fits = F.coalesce((F.size("embedding") == DIMENSIONS) & sound, F.lit(False))
    return table.where(fits).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def whole(x: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``: as doubles where all are small enough to be exact, else as Python's numbers."""
    if not x.size or np.abs(x).max() < NARROW // SCALE:
        return np.floor(x * SCALE)
    numbers = [int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE) for v in x.ravel().tolist()]
    return np.array(numbers, dtype=object).reshape(x.shape)


def _rows_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, square = 0, np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for batch in batches:
        x = np.clip(_rows_of(batch), -1e100, 1e100)
        n, total, square = n + len(x), total + x.sum(axis=0), square + (x * x).sum(axis=0)
    columns = [pa.array(np.arange(DIMENSIONS)), pa.array(np.full(DIMENSIONS, n)), pa.array(total), pa.array(square)]
    yield pa.RecordBatch.from_arrays(columns, names=["place", "n", "total", "square"])


def spread_of(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every component: one row for each."""
    parts = vectors.select("x").mapInArrow(_moments, "place long, n long, total double, square double")
    rows = parts.groupBy("place").agg(F.sum("n"), F.sum("total"), F.sum("square")).collect()
    mean, deviation = np.zeros(DIMENSIONS), np.ones(DIMENSIONS)
    for place, n, total, square in rows:
        if n:
            mean[place] = total / n
            deviation[place] = math.sqrt(max(0.0, square / n - mean[place] ** 2)) or 1.0
    return mean, deviation


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve, as rows of bytes, of points with whole coordinates below ``2 ** bits``.

    Coordinates are turned into the curve's own frame from the coarsest bit to the finest (a flip or
    an exchange with the first axis), then Gray-coded across axes; the bits of all axes, coarsest first, are
    the place.
    """
    axes = cells.astype(np.uint32).T.copy()
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for axis in axes:
            flip = (axis >> np.uint32(level)) & np.uint32(1) == 1
            change = np.where(flip, low, (axes[0] ^ axis) & low)
            axis ^= np.where(flip, np.uint32(0), change)
            axes[0] ^= change
    axes = np.bitwise_xor.accumulate(axes, axis=0)
    turned = np.zeros(axes.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turned ^= ((axes[-1] >> np.uint32(level)) & np.uint32(1)) * np.uint32((1 << level) - 1)
    axes ^= turned
    planes = [(axes >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _keyed(mean: np.ndarray, deviation: np.ndarray):
    order = np.argsort(-deviation, kind="stable")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = (_rows_of(batch) - mean) / deviation * (1 << BITS - 2)
            cells = np.clip(np.floor(z) + (1 << BITS - 1), 0, (1 << BITS) - 1)[:, order]
            keys = pa.array([k.tobytes() for k in hilbert_keys(cells, BITS)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), keys], names=["vec_id", "x", "key"])

    return run


def _pack(ids: list, x: np.ndarray) -> list:
    q = whole(x)
    if q.dtype == object:
        return [ids, True, x.tobytes(), None, None]
    return [ids, False, q.astype(np.int32).tobytes(), *(b.astype(np.int32).tobytes() for b in (q.min(axis=0), q.max(axis=0)))]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of the curve; a block may go on in the next batch."""
    ids, parts, names = [], [], [f.split()[0] for f in BLOCKS.split(", ")]

    def out(rows: list) -> pa.RecordBatch:
        kinds = [pa.list_(pa.int64()), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids += batch.column("vec_id").to_pylist()
        x = np.concatenate([*parts, _rows_of(batch)])
        upto = len(x) // BLOCK * BLOCK
        rows = [_pack(ids[k : k + BLOCK], x[k : k + BLOCK]) for k in range(0, upto, BLOCK)]
        ids, parts = ids[upto:], [x[upto:]]
        if rows:
            yield out(rows)
    if ids:
        yield out([_pack(ids, parts[0])])


def blocks_of(vectors: DataFrame) -> DataFrame:
    """Vectors in blocks along the curve, with the box of each. Written once, read in every round."""
    keyed = vectors.mapInArrow(_keyed(*spread_of(vectors)), KEYED)
    # Numbered, so that equal vectors may lie in several ranges, however many they are.
    keyed = stored.written(keyed.withColumn("row", F.monotonically_increasing_id()), "keyed")
    dealt = keyed.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    return stored.written(dealt.select("vec_id", "x").mapInArrow(_packed, BLOCKS), "blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that some point of a box may be nearest to, in order.

    The one nearest to the middle of the box rules out those that it is closer than, at every corner.
    """
    middle = (low + high) / 2
    pivot = centroids[((centroids - middle) ** 2).sum(axis=1).argmin()]
    apart = centroids - pivot
    # The greatest surplus of the pivot's squared distance over the other's.
    surplus = (pivot**2).sum() - (centroids**2).sum(axis=1) + 2 * np.maximum(low * apart, high * apart).sum(axis=1)
    return np.flatnonzero(surplus >= 0)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in ``centroids`` and squared distance of the nearest one; of equal ones the first."""
    if x.dtype == object or centroids.dtype == object:
        x, centroids = (v if v.dtype == object else v.astype(np.int64).astype(object) for v in (x, centroids))
        apart = [((x - c) ** 2).sum(axis=1).tolist() for c in centroids]
        best = [min(range(len(apart)), key=lambda j: (apart[j][i], j)) for i in range(len(x))]
        return np.array(best), np.array([apart[j][i] for i, j in enumerate(best)], dtype=object)
    apart = (x**2).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids**2).sum(axis=1)
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(x)), best].astype(np.int64)


def _as_array(centroids: list[list[int]]) -> np.ndarray:
    small = all(abs(v) < NARROW for row in centroids for v in row)
    return np.array(centroids, dtype=np.float64 if small else object)


def _assignments(batch: pa.RecordBatch, centroids: np.ndarray):
    """Per block its ids, vectors, centroids and distances."""
    for ids, wide, held, low, high in zip(*(batch.column(n).to_pylist() for n in batch.schema.names), strict=True):
        if wide:
            x, some = whole(np.frombuffer(held).reshape(-1, DIMENSIONS)), np.arange(len(centroids))
        else:
            x = np.frombuffer(held, np.int32).reshape(-1, DIMENSIONS).astype(np.float64)
            some = np.arange(len(centroids))
            if centroids.dtype != object:
                box = (np.frombuffer(b, np.int32).astype(np.float64) for b in (low, high))
                some = candidates(*box, centroids)
        best, distance = nearest(x, centroids[some])
        yield ids, x, some[best], distance


def _summed(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, sums = _as_array(centroids), {}, {}
        salt = 0
        for batch in batches:
            for ids, x, cluster, _ in _assignments(batch, known):
                salt = (salt * 31 + len(ids) + int(x[0, 0])) % SALTS
                for j in np.unique(cluster).tolist():
                    mine = x[cluster == j]
                    total = mine.sum(axis=0)
                    total = total if total.dtype == object else total.astype(np.int64).astype(object)
                    n[j] = n.get(j, 0) + len(mine)
                    sums[j] = sums[j] + total if j in sums else total
        columns = [pa.array(list(n), pa.int32()), pa.array([salt] * len(n), pa.int32()), pa.array(list(n.values()), pa.int64())]
        columns.append(pa.array([[str(v) for v in sums[j]] for j in n], pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "salt", "n", "sums"])

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = [str(sum(map(int, column))) for column in zip(*rows["sums"], strict=True)]
    return pd.DataFrame({"cluster": rows["cluster"].iloc[:1], "salt": [0], "n": [int(rows["n"].sum())], "sums": [total]})


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every centroid that has vectors goes to the floor of their mean."""
    parts = blocks.mapInArrow(_summed(centroids), SUMS)
    salted = parts.groupBy("cluster", "salt").applyInPandas(_added, SUMS)
    found = salted.groupBy("cluster").applyInPandas(_added, SUMS).collect()  # a row for each centroid
    out = list(centroids)
    for cluster, _, n, sums in found:
        out[cluster] = [int(v) // n for v in sums]
    return out


def _assigned(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _as_array(centroids)
        for batch in batches:
            ids, clusters, distances = [], [], []
            for some, _, cluster, distance in _assignments(batch, known):
                ids += some
                clusters += cluster.tolist()
                distances += [min(int(v), LARGEST) for v in distance]
            columns = [pa.array(ids, pa.int64()), pa.array(clusters, pa.int32()), pa.array(distances, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, count: int) -> list[list[int]]:
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "vec_id", "x").limit(count).collect()
    return [[int(v) for v in whole(np.array([row.x]))[0]] for row in rows]


def clustered(table: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every usable vector (``vec_id, embedding``), and the centroids."""
    vectors = usable(table)
    centroids = first_centroids(vectors, count)
    blocks = blocks_of(vectors)
    for _ in range(rounds if centroids else 0):
        centroids = moved(blocks, centroids)
    return stored.written(blocks.mapInArrow(_assigned(centroids), ASSIGNED), "assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Assignments with their cluster's and the whole inertia, and a digest of the centroid."""
    spark = assigned.sparkSession

    def shown(total):
        return F.least(total, F.lit(LARGEST).cast("decimal(38,0)")).cast("long")

    each = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("total"))
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    named = each.join(F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster")
    total = each.agg(F.sum("total").alias("total")).scalar()
    # One row for each centroid.
    few = F.broadcast(named.select("cluster", shown(F.col("total")).alias("cluster_inertia"), "centroid_sha256"))
    out = assigned.join(few, "cluster").withColumn("inertia", shown(total))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
