"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

A word is a run of letters in lower case, with its end as one more sign. A model gives each of
its signs (bytes) a probability after the five before it, by absolute discounting: what the class has
seen, less a discount, and the rest by the shared orders. Those hold continuation counts, by how many
different signs a run is preceded, over all documents, so that expressions too rare for a class are
judged by what the whole corpus writes, equally for both classes. Two such models, of toxic and of
ordinary labelled texts, give a text the difference of its log-likelihoods per byte, over the whole and over its
most telling words. A logistic function, fitted on labelled rows that the models it is fitted for
have not counted, turns these into a probability.

Class counts come from at most ``TRAINING_ROWS`` labelled documents of each class, whole texts, those of
smallest hashes of their ids, as many of one class as of the other; equal texts of a class count once. Shared counts come from all documents.
Counts are kept in tables of ``BUCKETS`` places, whatever the number of different runs.

Null, empty and letterless texts have all features 0 and get the score for that. Without labels of both kinds
every score is the share of label 1, or 0.5 (one is added to each kind). Of conflicting labels of a document the
larger counts; other values than 0 and 1 are no label. Very long texts are read whole. Repeated rows are scored
alike, null ids are scored, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtally.llm import stored, textbytes

# Signs of a run, the last of which is predicted, as classes and shared counts have them. The
# corpus is read in runs of one more sign, which fit a long.
ORDER = 6
_SHORT = (1 << 8 * ORDER) - 1
# Places of a table of counts (a prime).
BUCKETS = 262_139
# The bound of what a class is learned from.
TRAINING_ROWS = 6_000
# Different runs that a task holds before it hands them on.
HELD = 1 << 20
# How many words of a text are looked at by themselves: those with the greatest differences.
TELLING = (1, 2, 4, 8, 16)
FEATURES = 3 + 2 * len(TELLING)
# Labelled texts are counted in two folds, 0 and 1, and together.
BOTH = 2
THRESHOLD = 0.7


class Words(NamedTuple):
    """Different words of a block, and which of them each text consists of."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    which: np.ndarray
    counts: np.ndarray


def words_of(block: textbytes.Block) -> Words:
    data = textbytes._lower()[block.data]
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = letter[1:] != letter[:-1]
    change[block.starts] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    solid = letter[starts]
    starts, ends = starts[solid], ends[solid]
    counts = np.searchsorted(starts, block.ends) - np.searchsorted(starts, block.starts)
    _, first, which = np.unique(textbytes.Spans(data).hashes(starts, ends), return_index=True, return_inverse=True)
    return Words(data, starts[first], ends[first], which, counts)


def runs_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The runs that end with each sign of the different words, and where each word's begin.

    A run is one number, the predicted sign in its lowest byte; signs before the word are 0, as is its end.
    """
    sizes = words.ends - words.starts + 1
    begin = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    source = np.minimum(np.repeat(words.starts, sizes) + within, max(0, len(words.data) - 1))
    signs = np.where(within == np.repeat(sizes - 1, sizes), 0, words.data[source]).astype(np.int64)
    runs = signs.copy()
    for back in range(1, ORDER + 1):
        runs[back:] |= np.where(within[back:] >= back, signs[:-back], 0) << (8 * back)
    return runs, begin


def _distinct_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, size = [], 0
    for batch in batches:
        for block in textbytes.blocks(batch.column("text"), 1 << 20):
            known.append(np.unique(runs_of(words_of(block))[0]))
            size += len(known[-1])
            if size > HELD:
                known = [np.unique(np.concatenate(known))]
                size = len(known[0])
                if size > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(known[0])], names=["run"])
                    known, size = [], 0
    if known:
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(known)))], names=["run"])


class Counts(NamedTuple):
    """A table of runs, and of what precedes their last sign: how often, with how many different signs."""

    runs: np.ndarray
    before: np.ndarray
    kinds: np.ndarray
    discount: float


def _bucketed(runs: DataFrame, *keys: str) -> DataFrame:
    """``part, place, n, kinds`` of runs (``run, n``): part 0 by whole run, 1 by what precedes its last sign."""
    whole = runs.groupBy(*keys, (F.col("run") % BUCKETS).alias("place")).agg(F.sum("n").alias("n"), F.lit(0).cast("long").alias("kinds"))
    context = F.shiftright("run", 8) % BUCKETS
    before = runs.groupBy(*keys, context.alias("place")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
    return whole.withColumn("part", F.lit(0)).unionByName(before.withColumn("part", F.lit(1)))


def _table(part: np.ndarray, place: np.ndarray, n: np.ndarray, kinds: np.ndarray) -> Counts:
    runs, before, different = (np.zeros(BUCKETS, np.float32) for _ in range(3))
    whole = part == 0
    runs[place[whole]] = n[whole]
    before[place[~whole]] = n[~whole]
    different[place[~whole]] = kinds[~whole]
    once, twice = int((runs == 1).sum()), int((runs == 2).sum())
    return Counts(runs, before, different, once / (once + 2 * twice) if once and twice else 0.75)


def _collected(frame: DataFrame, *keys: str) -> dict[tuple, Counts]:
    """The tables by key. At most two rows for each place and key come to the driver."""
    found = frame.select(*keys, "part", "place", "n", "kinds").toArrow()
    columns = {name: found.column(name).to_numpy() for name in found.column_names}
    out = {}
    for key in sorted(set(zip(*(columns[k].tolist() for k in keys), strict=True))):
        mine = np.logical_and.reduce([columns[k] == v for k, v in zip(keys, key, strict=True)])
        out[key] = _table(*(columns[name][mine] for name in ("part", "place", "n", "kinds")))
    return out


def _empty() -> Counts:
    return Counts(*(np.zeros(BUCKETS, np.float32) for _ in range(3)), 0.75)


def lowered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.lower(F.col("text").cast("string")))


def shared_counts(docs: DataFrame) -> list[Counts]:
    """Continuation counts of orders 1 to ``ORDER`` over all documents."""
    known = lowered(docs.select("text")).mapInArrow(_distinct_runs, "run long").distinct()
    longer = stored.written(known, "runs")
    parts = None
    for order in range(ORDER, 0, -1):
        low = F.col("run").bitwiseAND(F.lit((1 << 8 * order) - 1)).alias("run")
        longer = stored.written(longer.groupBy(low).agg(F.count("*").alias("n")), "runs")
        mine = _bucketed(longer).withColumn("order", F.lit(order))
        parts = mine if parts is None else parts.unionByName(mine)
    found = _collected(parts, "order")
    return [found.get((order,), _empty()) for order in range(1, ORDER + 1)]


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: those whose id's crc32 leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fold, toxic = (batch.column(n).to_numpy() for n in ("fold", "toxic"))
        for block in textbytes.blocks(batch.column("text"), 1 << 20):
            words = words_of(block)
            runs, begin = runs_of(words)
            runs &= _SHORT
            sizes = np.diff(np.append(begin, len(runs)))
            text = np.repeat(np.arange(len(words.counts)), words.counts)
            rows = slice(block.first, block.first + len(block.starts))
            kind = (fold[rows] * 2 + toxic[rows])[text]
            for k in np.unique(kind).tolist():
                often = np.bincount(words.which[kind == k], minlength=len(begin))
                present, place = np.unique(runs, return_inverse=True)
                n = np.bincount(place, weights=np.repeat(often, sizes), minlength=len(present)).astype(np.int64)
                some = n > 0
                same = [pa.array(np.full(int(some.sum()), v, np.int32)) for v in divmod(k, 2)]
                columns = [*same, pa.array(present[some]), pa.array(n[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["fold", "toxic", "run", "n"])


def class_counts(chosen: DataFrame) -> dict[tuple[int, int], Counts]:
    """Counts by fold and class of chosen texts (``fold, toxic, text``); fold ``BOTH`` has all of a class."""
    runs = chosen.select("fold", "toxic", "text").mapInArrow(_counted, "fold int, toxic int, run long, n long")
    summed = stored.written(runs.groupBy("fold", "toxic", "run").agg(F.sum("n").alias("n")), "class-runs")
    both = summed.groupBy(F.lit(BOTH).alias("fold"), "toxic", "run").agg(F.sum("n").alias("n"))
    return _collected(_bucketed(summed.unionByName(both), "fold", "toxic"), "fold", "toxic")


def _smoothed(counts: Counts, runs: np.ndarray, below: np.ndarray) -> np.ndarray:
    before = (runs >> 8) % BUCKETS
    seen = counts.before[before]
    kept = np.maximum(counts.runs[runs % BUCKETS] - counts.discount, 0)
    share = (kept + counts.discount * counts.kinds[before] * below) / np.maximum(seen, 1)
    return np.where(seen > 0, np.clip(share, 1e-12, 1), below)


def differences(shared: list[Counts], ordinary: Counts, toxic: Counts, runs: np.ndarray) -> np.ndarray:
    """Per run the log-probability of its last sign by the toxic model less that by the ordinary one."""
    first = shared[0].runs[runs & 255]
    below = (first + 0.5) / (shared[0].runs.sum() + 128)
    for order in range(2, ORDER + 1):
        below = _smoothed(shared[order - 1], runs & ((1 << 8 * order) - 1), below)
    runs = runs & _SHORT
    return np.log(_smoothed(toxic, runs, below)) - np.log(_smoothed(ordinary, runs, below))


def features(shared: list[Counts], ordinary: Counts, toxic: Counts, block: textbytes.Block) -> np.ndarray:
    """Per text, from its words' differences: their sum per byte and per square root of bytes, the size, and for the
    most telling words their sum for each word and per byte."""
    words = words_of(block)
    out = np.zeros((len(words.counts), FEATURES))
    if not len(words.which):
        return out
    runs, begin = runs_of(words)
    each = np.add.reduceat(differences(shared, ordinary, toxic, runs), begin)[words.which]
    size = (words.ends - words.starts + 1)[words.which]
    filled = words.counts > 0
    first = (np.cumsum(words.counts) - words.counts)[filled]
    text = np.repeat(np.arange(int(filled.sum())), words.counts[filled])
    total, length = np.add.reduceat(each, first), np.add.reduceat(size, first)
    order = np.lexsort((-each, text))
    rank = np.arange(len(order)) - np.repeat(first, words.counts[filled])
    parts = [total / length, total / np.sqrt(length), np.log1p(length)]
    for most in TELLING:
        best = order[rank < most]
        told = np.bincount(text[best], weights=each[best], minlength=len(first))
        parts += [told / most, told / np.bincount(text[best], weights=size[best], minlength=len(first))]
    out[filled] = np.stack(parts, axis=1)
    return out


class Model(NamedTuple):
    shared: list[Counts]
    ordinary: Counts
    toxic: Counts
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def probability(model: Model, values: np.ndarray) -> np.ndarray:
    z = np.clip((values - model.centre) / model.scale, -8, 8) @ model.weights[:-1] + model.weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def logistic(values: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the last is the constant), by Newton's method with a small penalty."""
    centre, scale = values.mean(axis=0), values.std(axis=0) + 1e-6
    x = np.column_stack([np.clip((values - centre) / scale, -8, 8), np.ones(len(values))])
    weights = np.zeros(x.shape[1])
    penalty = np.diag([0.1] * values.shape[1] + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        slope = x.T @ (importance * (p - labels)) + penalty @ weights
        bend = (x * (importance * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        weights -= step * min(1.0, 4 / max(1e-12, float(np.abs(step).max())))
    return centre, scale, weights


def _constant(shared: list[Counts], share: float) -> Model:
    weights = np.zeros(FEATURES + 1)
    weights[-1] = np.log(share / (1 - share))
    return Model(shared, _empty(), _empty(), np.zeros(FEATURES), np.ones(FEATURES), weights)


def _valued(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, tables = shipped.value
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            values = np.zeros((batch.num_rows, FEATURES))
            for block in textbytes.blocks(batch.column("text"), 1 << 20):
                rows = np.arange(block.first, block.first + len(block.starts))
                for k in np.unique(fold[rows]).tolist():
                    mine = fold[rows] == k
                    values[rows[mine]] = features(shared, tables[1 - k, 0], tables[1 - k, 1], block)[mine]
            held = pa.array([v.tobytes() for v in values], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), held], names=["toxic", "held"])

    return run


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``rows`` texts of each class (``fold, toxic, text``), and how many there are of each."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = stored.written(usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "marked")
    totals = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}  # at most two rows
    order = (F.xxhash64("doc_id"), "doc_id")
    some = None
    # Equally many, so that chance has an equal part in both.
    rows = min(rows, *(totals.get(kind, 0) for kind in (0, 1))) or rows
    for kind in (0, 1):
        mine = marked.where(F.col("toxic") == kind).orderBy(*order).limit(rows)
        some = mine if some is None else some.unionAll(mine)
    # At most twice ``rows`` ids.
    texts = lowered(docs.select("doc_id", "text")).join(F.broadcast(some), "doc_id")
    fold = F.shiftright(F.xxhash64("text"), 7).bitwiseAND(F.lit(1)).cast("int").alias("fold")
    once = texts.where(F.col("text").isNotNull()).dropDuplicates(["toxic", "text"])
    return stored.written(once.select(fold, "toxic", "text"), "labelled"), totals


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Models of both classes, and the function of their differences. Labels are ``doc_id, toxic``."""
    chosen, totals = labelled(docs, labels, rows)
    shared = shared_counts(docs)
    # Copies were put together, so what is there of each class may be less.
    there = {r[0]: r[1] for r in chosen.groupBy("toxic").count().collect()}
    if not (there.get(0) and there.get(1)):
        return _constant(shared, (totals.get(1, 0) + 1) / (sum(totals.values()) + 2))
    tables = class_counts(chosen)
    for fold in (0, 1, BOTH):
        for kind in (0, 1):
            tables.setdefault((fold, kind), _empty())
    shipped = docs.sparkSession.sparkContext.broadcast((shared, tables))
    found = chosen.mapInArrow(_valued(shipped), "toxic int, held binary").orderBy("toxic", "held").limit(2 * rows).collect()
    values = np.frombuffer(b"".join(r[1] for r in found)).reshape(-1, FEATURES)
    kinds = np.array([r[0] for r in found])
    # As many as there are of each class, not as many as were chosen.
    importance = np.where(kinds == 1, totals[1] / there[1], totals[0] / there[0])
    fitted = logistic(values, kinds, importance * len(kinds) / importance.sum())
    return Model(shared, tables[BOTH, 0], tables[BOTH, 1], *fitted)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            blocks = textbytes.blocks(batch.column("text"), 1 << 20)
            found = [probability(model, features(model.shared, model.ordinary, model.toxic, b)) for b in blocks]
            out = pa.array(np.concatenate(found) if found else [], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return lowered(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, score double")
