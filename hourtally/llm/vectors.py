"""Near-duplicate vectors by cosine, with a product-quantised index.

Vectors are scaled to length 1 and put into the list of the nearest coarse centre; what is
left is written as one code for each subspace. A vector probes the lists of the ``PROBES`` nearest centres, of
those that can hold one within reach: a vector there lies beyond the plane half-way between the two centres, so
planes further off than the reach rule a list out. So many probes find over 0.99 of links (README); without a bound
(``probes=None``) nothing linked is missed, at a cost that grows faster than the table. In a list,
distances are read from tables of query parts against codes (asymmetric: the query is not
coded); pairs whose distance cannot be in reach, given the known error of the code, are
dropped, and the rest are compared by exact cosine in double precision.

A null ``vec_id`` takes part, links like any other, and is never the smallest id unless all of its component are null.
Links are those of at least the cosine asked for, ties included. Equal vectors are one class before any comparison. Lists are dealt out in blocks, queries
stream past a block, and what leaves a task is a count and one link for each vector in it, not
pairs. The index is fitted on at most ``SAMPLE`` different vectors and holds all.

Vectors that are null, zero, empty or hold null or non-finite components link with nothing, and
vectors of different dimension do not link with each other. Repeated rows and ids are
rows of their own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtally.llm import graph, stored

LEAST_COSINE = 0.95
# The bound of what the index is fitted on.
SAMPLE = 20_000
LIST_SIZE = 1000
MOST_LISTS = 4096
# Centres whose planes are looked at for each vector.
PLANES = 16
# Lists that a vector is held against, at most.
PROBES = 16
SUBSPACES = 8
CODES = 256
# Vectors of a block, and queries held against it at a time.
BLOCK = 1024
QUERIES = 1024


class Index(NamedTuple):
    centres: np.ndarray
    cuts: np.ndarray
    books: list[np.ndarray]


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _means(points: np.ndarray, count: int, steps: int = 12) -> np.ndarray:
    """Centres of groups of points, by Lloyd's steps."""
    draw = np.random.default_rng(5)
    centres = points[np.sort(draw.permutation(len(points))[:count])].copy()
    for _ in range(steps):
        own = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(centres))
        filled = sizes > 0
        centres[filled] = sums[filled] / sizes[filled, None]
    return centres


def fit(points: np.ndarray, total: int) -> Index:
    """From a sample of unit vectors of ``total``."""
    lists = max(1, min(MOST_LISTS, len(points), total // LIST_SIZE))
    centres = _means(points, lists)
    rest = points - centres[_nearest(points, centres)]
    cuts = np.linspace(0, points.shape[1], min(SUBSPACES, points.shape[1]) + 1).astype(int)
    books = [_means(rest[:, a:b], min(CODES, len(rest))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return Index(centres, cuts, books)


def coded(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """List, codes and length of what the codes leave out, of each vector."""
    own = _nearest(points, index.centres)
    rest = points - index.centres[own]
    codes = np.empty((len(points), len(index.books)), np.uint8)
    left = np.zeros(len(points))
    for m, book in enumerate(index.books):
        part = rest[:, index.cuts[m] : index.cuts[m + 1]]
        codes[:, m] = _nearest(part, book)
        left += ((part - book[codes[:, m]]) ** 2).sum(axis=1)
    return own, codes, np.sqrt(left)


def probed(index: Index, points: np.ndarray, own: np.ndarray, reach: float, probes: int | None = None) -> np.ndarray:
    """By vector and list: can the list hold a vector within reach, and is it one of the ``probes`` nearest?

    The planes half-way to the centres nearest to the vector are looked at.
    """
    centres = index.centres
    squares = (centres**2).sum(axis=1)
    far = squares[None, :] - 2 * points @ centres.T
    near = np.argpartition(far, min(PLANES, len(centres)) - 1, axis=1)[:, :PLANES]
    apart = np.sqrt(np.maximum(0, squares[None, :] + squares[:, None] - 2 * centres @ centres.T))
    out = np.ones(far.shape, bool)
    for k in range(near.shape[1]):
        other = near[:, k]
        beyond = far - far[np.arange(len(points)), other][:, None]
        out &= beyond <= 2 * apart[other] * reach + 1e-9
    if probes is not None and probes < len(centres):
        out &= far <= np.partition(far, probes - 1, axis=1)[:, probes - 1 : probes]
    out[np.arange(len(points)), own] = True
    return out


def _unit(column: pa.Array, rows: int) -> np.ndarray:
    points = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    points = points / np.abs(points).max(axis=1, keepdims=True)  # so that no square runs over
    return points / np.sqrt((points * points).sum(axis=1, keepdims=True))


DEALT = "list int, block int, role int, node long, home int, times long, vector array<double>, codes binary, left_out double"
FOUND = "node long, n long, link long"


def _deal(index, blocks, reach, probes):
    """Each vector once as a member of its list, and as a query for every list it probes up
    to its own, so that two lists meet once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                points = _unit(batch.column("embedding"), batch.num_rows)
                own, codes, left = coded(index.value, points)
                near = probed(index.value, points, own, reach, probes)
                near &= np.arange(near.shape[1])[None, :] <= own[:, None]
                row, into = np.nonzero(near)
                number = blocks.value[into]
                row = np.repeat(row, number)
                into = np.repeat(into, number)
                block = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
                nodes = batch.column("node").to_numpy()
                mine = (nodes.astype(np.uint64) % blocks.value[own].astype(np.uint64)).astype(np.int64)
                rows = np.concatenate([np.arange(len(own)), row])
                role = np.concatenate([np.zeros(len(own)), np.ones(len(row))])
                columns = [
                    pa.array(np.concatenate([own, into]), pa.int32()),
                    pa.array(np.concatenate([mine, block]), pa.int32()),
                    pa.array(role.astype(np.int32)),
                    pa.array(nodes[rows]),
                    pa.array(own[rows], pa.int32()),
                    batch.column("times").take(pa.array(rows)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(rows) + 1) * points.shape[1], pa.int32()), pa.array(points[rows].reshape(-1))
                    ),
                    pa.array([c.tobytes() if r == 0 else b"" for c, r in zip(codes[rows], role, strict=True)], pa.binary()),
                    pa.array(left[rows]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in DEALT.split(", ")])

    return run


class _Block:
    """The members of one block, and what queries have found among them."""

    def __init__(self, index: Index, which: int, least: float):
        self.index, self.which, self.least = index, which, least
        self.parts: list[tuple] = []
        self.members = None

    def add(self, rows: tuple) -> None:
        self.parts.append(rows)

    def _members(self) -> tuple:
        if self.members is None:
            self.members = tuple(np.concatenate(x) for x in zip(*self.parts, strict=True))
        return self.members

    def hold(self, nodes, home, times, points) -> Iterator[tuple[np.ndarray, ...]]:
        """What some queries find: node, how many it links with, and one of its class."""
        if not self.parts:
            return
        m_nodes, m_times, m_points, m_codes, m_left = self._members()
        rest = points - self.index.centres[self.which]
        # A row for each code or member, so that whole rows are read; single precision, with room.
        far = np.zeros((len(m_nodes), len(points)), np.float32)
        read = np.empty_like(far)
        for m, book in enumerate(self.index.books):
            part = rest[:, self.index.cuts[m] : self.index.cuts[m + 1]]
            table = (part * part).sum(axis=1)[None, :] + (book * book).sum(axis=1)[:, None] - 2 * book @ part.T
            np.take(table.astype(np.float32), m_codes[:, m], axis=0, out=read, mode="clip")
            far += read
        reach = np.sqrt(2 - 2 * self.least) + 1e-4
        x, q = np.nonzero(far <= ((reach + m_left) ** 2 + 1e-4).astype(np.float32)[:, None])
        once = (home[q] != self.which) | (nodes[q] < m_nodes[x])
        q, x = q[once], x[once]
        cosine = np.concatenate(
            [(points[q[k : k + 65536]] * m_points[x[k : k + 65536]]).sum(axis=1) for k in range(0, len(q), 65536)]
            or [np.zeros(0)]
        )
        q, x = q[cosine >= self.least], x[cosine >= self.least]
        if not len(q):
            return
        # One number for each vector in sight, queries before members; the same node has one.
        every, number = np.unique(np.concatenate([nodes, m_nodes]), return_inverse=True)
        a, b = number[q], number[len(nodes) + x]
        label = np.arange(len(every))
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            if (new == label).all():
                break
            label = new
        counts = np.bincount(a, m_times[x], len(every)) + np.bincount(b, times[q], len(every))
        seen = np.flatnonzero(counts)
        yield every[seen], counts[seen].astype(np.int64), every[label[seen]]


def _compare(index, least):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, None
        for whole in batches:
            place = np.stack([whole.column(n).to_numpy() for n in ("list", "block", "role")], axis=1)
            edges = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            bounds = [0, *edges.tolist(), len(place)] if len(place) else []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                key = (int(place[lo, 0]), int(place[lo, 1]))
                if key != current:
                    current, block = key, _Block(index.value, key[0], least)
                for at in range(lo, hi, QUERIES):
                    batch = whole.slice(at, min(QUERIES, hi - at))
                    nodes, times, home = (batch.column(n).to_numpy() for n in ("node", "times", "home"))
                    points = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
                    if place[lo, 2] == 0:
                        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8)
                        block.add((nodes, times, points, codes.reshape(batch.num_rows, -1), batch.column("left_out").to_numpy()))
                    else:
                        for found in block.hold(nodes, home, times, points):
                            arrays = [pa.array(x, pa.int64()) for x in found]
                            yield pa.RecordBatch.from_arrays(arrays, names=["node", "n", "link"])

    return run


def _lists(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _nearest(_unit(batch.column("embedding"), batch.num_rows), index.value.centres)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32())], names=["list"])

    return run


def found_links(classes: DataFrame, least: float = LEAST_COSINE, probes: int | None = PROBES) -> DataFrame:
    """``node, n, link`` from classes ``node, embedding, times`` of one dimension.

    Sums of ``n`` by node count the vectors of other classes a vector links with; ``link`` is a
    node it is connected to.
    """
    context = classes.sparkSession.sparkContext
    total = classes.count()
    sample = classes.select("node", "embedding").orderBy("node").limit(SAMPLE).collect()
    points = np.array([r[1] for r in sample], np.float64)
    points /= np.abs(points).max(axis=1, keepdims=True)
    points /= np.sqrt((points * points).sum(axis=1, keepdims=True))
    index = context.broadcast(fit(points, total))
    sizes = classes.select("embedding").mapInArrow(_lists(index), "list int").groupBy("list").count().collect()
    blocks = np.ones(len(index.value.centres), np.int64)
    for which, size in sizes:  # one row for each list, at most MOST_LISTS
        blocks[which] = -(-size // BLOCK)
    reach = float(np.sqrt(2 - 2 * least)) + 1e-6
    dealt = classes.mapInArrow(_deal(index, context.broadcast(blocks), reach, probes), DEALT)
    met = dealt.repartition("list", "block").sortWithinPartitions("list", "block", "role")
    return met.mapInArrow(_compare(index, least), FOUND)


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, probes: int | None = PROBES) -> DataFrame:
    """Per row of ``vectors`` (``vec_id, embedding``): ``vec_id, n_links, component_id``."""
    value = F.col("embedding").cast("array<double>")
    largest = F.array_max(F.transform(value, F.abs))
    sound = ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("embedding").isNotNull() & sound & (largest > 0), F.lit(False))
    key = F.when(usable, F.xxhash64(value))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("embedding"), key.alias("node"))
    grouped = rows.where("node IS NOT NULL").groupBy("node")
    every = grouped.agg(F.first("embedding").alias("embedding"), F.count("*").alias("times"), F.min("vec_id").alias("least"))
    classes = stored.written(every, "vectors")
    dimensions = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    parts = [found_links(classes.where(F.size("embedding") == d), least, probes) for d in sorted(dimensions)]
    empty = vectors.sparkSession.createDataFrame([], FOUND)
    found = stored.written(reduce(DataFrame.unionAll, parts, empty), "links")
    joined = graph.components(found.select(F.col("node").alias("a"), F.col("link").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = classes.select("node", "times", "least").join(counts, "node", "left").join(joined, "node", "left")
    named = named.withColumn("class", F.coalesce("component", "node"))
    lowest = named.groupBy("class").agg(F.min("least").alias("component_id"))
    links = F.col("times") - 1 + F.coalesce("n", F.lit(0))
    # Written, so that Spark may split a join with very many equal vectors.
    named = stored.written(named.join(lowest, "class").select("node", links.alias("n_links"), "component_id"), "classes")
    shown = rows.select("vec_id", "node").join(named, "node", "left")
    return shown.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
