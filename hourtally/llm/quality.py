"""Text quality: random-indexing word vectors, pooled by document, and a small network.

Every word has a random index vector of few +1 and -1. A word's vector is the sum of the
index vectors of its neighbours over the whole corpus, and of its own. Words are
hashed to ``BUCKETS`` rows, so the table has a fixed size whatever the vocabulary. A
document is the mean and the spread of its words' vectors; a network of two layers, trained
on a bounded sample of labelled documents, scores it, and one temperature fitted on rows it
was not trained on turns scores into probabilities.

Words are runs of letters, of digits, or of other signs, in the case they are in. Null and
empty texts have all features 0 and get the network's score for that. Without labels of both
kinds every score is the share of label 1, or 0.5. Of conflicting labels of one document the largest counts.
Very long texts are pooled whole, in blocks of their own. Repeated rows are scored alike; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtally.llm import textbytes

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 32
NONZERO = 4
REACH = 2
# The table is added up in this many parts, and in so many steps for each first.
PARTS = 16
SALTS = 32
# The bound of what the network is trained on, and of what its temperature is fitted on.
TRAINING_ROWS = 12_000
HIDDEN = 32
EPOCHS = 60
THRESHOLD = 0.3


@cache
def index_vectors() -> np.ndarray:
    draw = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIMENSIONS), np.int8)
    places = np.argsort(draw.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, draw.choice(np.array([-1, 1], np.int8), (BUCKETS, NONZERO)), axis=1)
    return out


@cache
def _kinds() -> np.ndarray:
    """By byte: 0 white space, 1 letter, 2 digit, 3 any other sign."""
    kinds = np.full(256, 3, np.uint8)
    kinds[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    kinds[65:91] = kinds[97:123] = kinds[128:] = 1
    kinds[48:58] = 2
    return kinds


def word_buckets(block: textbytes.Block) -> tuple[np.ndarray, np.ndarray]:
    """The words' buckets in order, and the number of words of each text."""
    kinds = _kinds()[block.data]
    change = np.ones(len(kinds) + 1, bool)
    change[1:-1] = kinds[1:] != kinds[:-1]
    change[block.starts] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    solid = kinds[starts] > 0
    starts, ends = starts[solid], ends[solid]
    hashes = textbytes.Spans(block.data).hashes(starts, ends)
    counts = np.searchsorted(starts, block.ends) - np.searchsorted(starts, block.starts)
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), counts


def _neighbours(buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For every word the sum of the index vectors around it, within its text."""
    vectors = index_vectors()[buckets]
    text = np.repeat(np.arange(len(counts)), counts)
    out = vectors.astype(np.int16)
    for step in range(1, REACH + 1):
        same = (text[step:] == text[:-step])[:, None]
        out[step:] += vectors[:-step] * same
        out[:-step] += vectors[step:] * same
    return out


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's part of the table, in parts."""
    total = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    seen = False
    salt = 0
    for batch in batches:
        for block in textbytes.blocks(batch.column("text"), 1 << 19):
            if not seen:
                salt = len(block.data) % SALTS
            seen = True
            buckets, counts = word_buckets(block)
            around = _neighbours(buckets, counts)
            order = np.argsort(buckets.astype(np.uint16), kind="stable")
            present, first = np.unique(buckets[order], return_index=True)
            if len(present):
                total[present] += np.add.reduceat(around[order].astype(np.int32), first, axis=0)
    if seen:
        yield _parts(total, np.full(PARTS, salt))


def _parts(total: np.ndarray, salts: np.ndarray) -> pa.RecordBatch:
    held = [x.tobytes() for x in total.reshape(PARTS, -1)]
    columns = [pa.array(np.arange(PARTS)), pa.array(salts.astype(np.int64)), pa.array(held, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["part", "salt", "sums"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each key, which come one after another."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for part, salt, held in zip(*(batch.column(n) for n in ("part", "salt", "sums")), strict=True):
            key = (part.as_py(), salt.as_py())
            value = np.frombuffer(held.as_py(), np.int64)
            sums[key] = sums[key] + value if key in sums else value
    if sums:
        columns = [pa.array([k[i] for k in sums], pa.int64()) for i in (0, 1)]
        columns.append(pa.array([v.tobytes() for v in sums.values()], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=["part", "salt", "sums"])


SUMS = "part long, salt long, sums binary"


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors of a corpus, each of length 1. Its size is fixed."""
    partial = docs.select("text").mapInArrow(_gather, SUMS)
    salted = partial.repartition("part", "salt").mapInArrow(_add_up, SUMS)
    whole = salted.withColumn("salt", F.lit(0).cast("long")).repartition("part").mapInArrow(_add_up, SUMS)
    total = np.zeros((PARTS, BUCKETS // PARTS * DIMENSIONS), np.int64)
    for part, _, held in whole.collect():  # at most PARTS rows
        total[part] += np.frombuffer(held, np.int64)
    table = total.reshape(BUCKETS, DIMENSIONS).astype(np.float64)
    table /= np.maximum(1e-9, np.linalg.norm(table, axis=1, keepdims=True))
    own = index_vectors() / np.sqrt(NONZERO)
    return ((table + own) / 2).astype(np.float32)


def features(table: np.ndarray, block: textbytes.Block) -> np.ndarray:
    """Mean and spread of the words' vectors of each text."""
    buckets, counts = word_buckets(block)
    out = np.zeros((len(counts), 2 * DIMENSIONS), np.float32)
    filled = counts > 0
    if filled.any():
        vectors = table[buckets]
        first = (np.cumsum(counts) - counts)[filled]
        n = counts[filled][:, None]
        mean = np.add.reduceat(vectors, first, axis=0) / n
        square = np.add.reduceat(vectors * vectors, first, axis=0) / n
        out[filled, :DIMENSIONS] = mean
        out[filled, DIMENSIONS:] = np.sqrt(np.maximum(0, square - mean * mean))
    return out


class Network(NamedTuple):
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float


def score(network: Network, values: np.ndarray) -> np.ndarray:
    hidden = np.tanh((values - network.centre) / network.scale @ network.first + network.first_bias)
    return 1 / (1 + np.exp(-np.clip((hidden @ network.second + network.second_bias) / network.temperature, -50, 50)))


def train(values: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> Network:
    """By Adam on four fifths of the rows; the temperature on the last fifth."""
    width = 2 * DIMENSIONS
    zero = np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN)
    if len(np.unique(labels)) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Network(np.zeros(width), np.ones(width), *zero, float(np.log(share / (1 - share))), 1.0)
    draw = np.random.default_rng(11)
    order = draw.permutation(len(labels))
    cut = max(1, len(order) * 4 // 5)
    used, rest = order[:cut], order[cut:]
    centre = values[used].mean(axis=0).astype(np.float64)
    scale = values[used].std(axis=0).astype(np.float64) + 1e-4
    x, y = (values[used] - centre) / scale, labels[used].astype(np.float64)
    p = [draw.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, 0.1, HIDDEN), np.zeros(1)]
    moment, spread = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    step = 0
    for _ in range(epochs):
        for some in np.array_split(draw.permutation(len(y)), max(1, len(y) // 128)):
            hidden = np.tanh(x[some] @ p[0] + p[1])
            out = 1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -50, 50)))
            off = (out - y[some]) / len(some)
            back = np.outer(off, p[2]) * (1 - hidden * hidden)
            slopes = [x[some].T @ back + 1e-4 * p[0], back.sum(axis=0), hidden.T @ off + 1e-4 * p[2], off.sum(keepdims=True)]
            step += 1
            for k, slope in enumerate(slopes):
                moment[k] = 0.9 * moment[k] + 0.1 * slope
                spread[k] = 0.999 * spread[k] + 0.001 * slope * slope
                p[k] -= 0.004 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
    network = Network(centre, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if not len(rest):
        return network

    def loss(temperature: float) -> float:
        out = np.clip(score(network._replace(temperature=temperature), values[rest]), 1e-9, 1 - 1e-9)
        return -float(np.mean(np.where(labels[rest] == 1, np.log(out), np.log(1 - out))))

    return network._replace(temperature=float(min(np.geomspace(0.25, 8, 61), key=loss)))


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: those whose id's crc32 is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _featured(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(table.value, block) for block in textbytes.blocks(batch.column("text"), 1 << 19)]
            values = [x.tobytes() for part in found for x in part]
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(values, pa.binary())], names=["quality", "it"])

    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of all documents, and the network trained on labelled ones.

    Labels are ``doc_id, quality``; other values than 0 and 1 are no label.
    """
    table = word_vectors(docs)
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    chosen = F.broadcast(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    shipped = docs.sparkSession.sparkContext.broadcast(table)
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("quality", "text")
    found = texts.mapInArrow(_featured(shipped), "quality int, it binary").orderBy("it", "quality").limit(rows).collect()
    values = np.frombuffer(b"".join(r[1] for r in found), np.float32).reshape(-1, 2 * DIMENSIONS)
    return table, train(values, np.array([r[0] for r in found]))


def scored(docs: DataFrame, table: np.ndarray, network: Network) -> DataFrame:
    """``doc_id, score`` for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast((table, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, network = shipped.value
        for batch in batches:
            found = [score(network, features(table, b)) for b in textbytes.blocks(batch.column("text"), 1 << 19)]
            out = pa.array(np.concatenate(found) if found else [], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
