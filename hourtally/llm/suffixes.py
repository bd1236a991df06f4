"""Removing byte strings that occur more than once, by suffix arrays.

Every 200-byte window of every text is compared with every other. A window names one of
its 48-byte spans, the one of least hash; equal windows name equal spans. So windows are
gathered by the span they name: a context is a run of neighbouring windows of one text
that name the same span. Only spans named in two places matter, equal contexts count once,
and the contexts of a span meet in one task, which sorts their suffixes in two stages
and compares neighbours. Spans with very many different contexts are split up by window
instead, so no task gets them whole.

A null text is empty. Texts under 200 bytes have no window. Repeated rows are repeats of
each other, so their long texts go entirely. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtally.llm import stored, textbytes

WINDOW = 200
SPAN = 48
# Spans with more different contexts than this are split up by window.
TOGETHER = 2000
# Bytes of contexts sorted at a time.
SORTED = 1 << 18
# Windows of a long text looked at together, with the bytes they need.
PIECE = 1 << 22

PLACE_BITS = 24


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the place of the (first) least one."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    count = len(hashes)
    padded = np.full(-(-count // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:count] = (hashes & ~low) | np.arange(count, dtype=np.uint64)
    rows = padded.reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).reshape(-1)
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    runs = count - width + 1
    return (np.minimum(onward[:runs], upto[width - 1 : width - 1 + runs]) & low).astype(np.int64)


def contexts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts of texts in one byte array: text number, first and last window, hash of the
    span named, hash of the context."""
    if len(data) < WINDOW:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    spans = textbytes.Spans(data)
    hashes = spans.grams(SPAN)
    named = _least_places(hashes, WINDOW - SPAN + 1)
    change = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= WINDOW
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - WINDOW + 1, -1)
    at = np.flatnonzero(np.cumsum(change[: len(named)]))
    if not len(at):
        return contexts(data[:0], starts[:0], ends[:0])
    names = named[at]
    new = np.flatnonzero((names[1:] != names[:-1]) | (at[1:] != at[:-1] + 1)) + 1
    first = at[np.concatenate([[0], new])]
    last = at[np.concatenate([new - 1, [len(at) - 1]])]
    name = named[first]
    sizes = (last - first).astype(np.uint64) * np.uint64(textbytes.RADIX) + (name - first).astype(np.uint64)
    whole = textbytes.mix(spans.raw(first, last + WINDOW) ^ textbytes.mix(sizes))
    text = np.searchsorted(starts, first, "right") - 1
    return text, first - starts[text], last - starts[text], hashes[name], whole


def _pieces(block: textbytes.Block) -> Iterator[tuple[np.ndarray, ...]]:
    """Contexts of a block; a single text longer than a piece is gone through piece by piece."""
    size = len(block.data)
    if size <= PIECE:
        yield contexts(block.data, block.starts, block.ends)
        return
    for at in range(0, size, PIECE):
        part = block.data[at : at + PIECE + WINDOW - 1]
        text, first, last, span, whole = contexts(part, np.zeros(1, np.int64), np.array([len(part)]))
        yield text, first + at, last + at, span, whole


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("row_key").to_numpy()
        for block in textbytes.blocks(batch.column("text")):
            for text, first, last, span, whole in _pieces(block):
                columns = [span.view(np.int64), whole.view(np.int64), keys[block.first + text], first, last]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["span", "context", "row_key", "first", "last"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted context, from the text it is in."""
    for batch in batches:
        data, offsets = textbytes.column_bytes(batch.column("text"))
        wanted = batch.column("wanted")
        rows = wanted.flatten()
        text = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
        first = offsets[text] + rows.field("first").to_numpy()
        upto = offsets[text] + rows.field("last").to_numpy() + WINDOW
        held = [data[i:j].tobytes() for i, j in zip(first.tolist(), upto.tolist(), strict=True)]
        columns = [rows.field("span"), rows.field("context"), rows.field("times"), rows.field("others")]
        columns.append(pa.array(held, pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=["span", "context", "times", "others", "bytes"])


def suffix_array(text: bytes, depth: int = WINDOW) -> np.ndarray:
    """Places in the order of the suffixes there, as far as their first ``depth`` bytes go.

    Stage one sorts only suffixes that are smaller than the suffix one place on. Stage two
    goes through the buckets of equal first bytes in order and puts each suffix's left
    neighbour, where that is a larger one, next into the bucket of its byte.
    """
    data = np.frombuffer(text, np.uint8)
    count = len(data)
    differs = np.flatnonzero(data[1:] != data[:-1])
    smaller = np.zeros(count, bool)
    if len(differs):
        following = np.searchsorted(differs, np.arange(int(differs[-1]) + 1))
        smaller[: int(differs[-1]) + 1] = (data[:-1] < data[1:])[differs[following]]
    places = np.flatnonzero(smaller)
    pieces = [text[i : i + depth] for i in places.tolist()]
    places = places[np.array(sorted(range(len(pieces)), key=pieces.__getitem__), np.int64)]
    del pieces
    bounds = np.searchsorted(data[places], np.arange(257))
    heads: list[list[np.ndarray]] = [[] for _ in range(256)]
    heads[data[-1]].append(np.array([count - 1]))
    order = []

    def induce(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[~smaller[before]]
        values = data[before]
        by_value = np.argsort(values, kind="stable")
        before, values = before[by_value], values[by_value]
        for part in np.split(before, np.flatnonzero(values[1:] != values[:-1]) + 1):
            if len(part):
                heads[data[part[0]]].append(part)

    for value in range(256):
        waves = heads[value]
        for wave in waves:  # grows while it is gone through, by runs of the same byte
            order.append(wave)
            induce(wave)
        direct = places[bounds[value] : bounds[value + 1]]
        if len(direct):
            order.append(direct)
            induce(direct)
    return np.concatenate(order)


def repeated(held: list[bytes]) -> list[np.ndarray]:
    """For each of the byte strings, which of its windows occur again among them all."""
    text = b"".join(held)
    sizes = np.array([len(x) for x in held])
    ends = np.cumsum(sizes)
    usable = np.ones(len(text), bool)
    for k in range(1, WINDOW):
        usable[ends - k] = False
    order = suffix_array(text)
    order = order[usable[order]]
    data = np.frombuffer(text + bytes(8), np.uint8)
    eight = np.zeros(len(text), np.uint64)
    for k in range(8):
        eight |= data[k : k + len(text)].astype(np.uint64) << np.uint64(8 * k)
    same = np.arange(len(order) - 1)
    for k in range(0, WINDOW, 8):
        same = same[eight[order[same] + k] == eight[order[same + 1] + k]]
    marked = np.zeros(len(text), bool)
    marked[order[same]] = True
    marked[order[same + 1]] = True
    return [marked[end - size : end - WINDOW + 1] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]


MARKS = "span long, context long, first long, last long"


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by span; the contexts of a span are looked at together."""

    def found(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        for (span, context, times, _), mark in zip(rows, repeated([r[3] for r in rows]), strict=True):
            if times > 1:
                continue  # all its windows repeat, as is known without looking
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mark.view(np.int8), [0]])))
            out.extend((span, context, i, j - 1) for i, j in edges.reshape(-1, 2).tolist())
        columns = zip(*out, strict=True) if out else [[]] * 4
        arrays = [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["span", "context", "first", "last"])

    rows, size, last = [], 0, None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("span", "context", "times", "bytes")]
        for row in zip(*columns, strict=True):
            if size >= SORTED and row[0] != last:
                yield found(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[3])
            last = row[0]
    if rows:
        yield found(rows)


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column("bytes").to_pylist()
        if not held:
            continue
        data = np.frombuffer(b"".join(held), np.uint8)
        sizes = np.array([len(x) for x in held])
        counts = sizes - WINDOW + 1
        row = np.repeat(np.arange(batch.num_rows), counts)
        at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes = textbytes.Spans(data).grams(WINDOW)[(np.cumsum(sizes) - sizes)[row] + at]
        columns = [pa.array(hashes.view(np.int64)), batch.column("span").take(pa.array(row))]
        columns += [batch.column("context").take(pa.array(row)), pa.array(at)]
        yield pa.RecordBatch.from_arrays(columns, names=["window", "span", "context", "at"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        data, offsets = textbytes.column_bytes(batch.column("text"))
        spans, kept = [], []
        for i, marks in enumerate(batch.column("marks").to_pylist()):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            runs: list[list[int]] = []
            for mark in sorted((m["first"], m["last"] + WINDOW) for m in marks or ()):
                if runs and mark[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], mark[1])
                else:
                    runs.append([*mark])
            spans.append([{"start": a, "end": b} for a, b in runs])
            bounds = [0, *(x for run in runs for x in run), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
        sizes = pa.array(np.diff(offsets), pa.int64())
        columns = [batch.column("row_key"), batch.column("doc_id"), sizes, pa.array(spans, kind)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(kept, pa.binary())], names=["row_key", "doc_id", "n_bytes", "spans", "kept"]
        )


def repeated_windows(texts: DataFrame) -> DataFrame:
    """``row_key, first, last``: runs of windows that occur elsewhere too."""
    every = stored.written(
        texts.select("row_key", "text").mapInArrow(
            _contexts, "span long, context long, row_key long, first long, last long"
        ),
        "contexts",
    )
    # Counts are written before they are joined, so that Spark may split a join with very many
    # rows of one span.
    often = stored.written(every.groupBy("span").agg(F.count("*").alias("n")).where("n > 1").select("span"), "spans")
    places = stored.written(every.join(often, "span", "left_semi"), "repeats")
    one = F.min(F.struct("row_key", "first", "last")).alias("one")
    distinct = stored.written(places.groupBy("span", "context").agg(F.count("*").alias("times"), one), "distinct")
    others = distinct.groupBy("span").agg(F.count("*").alias("others")).where("others > 1")
    others = stored.written(others, "others")
    wanted = distinct.join(others, "span").select(
        F.col("one.row_key").alias("row_key"),
        F.struct("span", "context", "times", "others", "one.first", "one.last").alias("it"),
    )
    by_text = wanted.groupBy("row_key").agg(F.collect_list("it").alias("wanted"))
    named = by_text.join(texts.select("row_key", "text"), "row_key").dropDuplicates(["row_key"])
    bytes_of = "span long, context long, times long, others long, bytes binary"
    cut = stored.written(named.select("text", "wanted").mapInArrow(_cut, bytes_of), "cut")
    few = cut.where(F.col("others") <= TOGETHER).drop("others")
    dealt = few.repartition("span").sortWithinPartitions("span", "context")
    sorted_marks = dealt.mapInArrow(_marks, MARKS)
    many = cut.where(F.col("others") > TOGETHER).select("span", "context", "bytes")
    windows = many.mapInArrow(_window_hashes, "window long, span long, context long, at long")
    again = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    again = stored.written(again, "windows")
    split_marks = windows.join(again, "window", "left_semi").select(
        "span", "context", F.col("at").alias("first"), F.col("at").alias("last")
    )
    whole = distinct.where("times > 1").select(
        "span", "context", F.lit(0).cast("long").alias("first"), (F.col("one.last") - F.col("one.first")).alias("last")
    )
    marks = stored.written(sorted_marks.unionAll(split_marks).unionAll(whole), "marks")
    marks = marks.withColumnsRenamed({"first": "from", "last": "upto"})
    return places.join(marks, ["span", "context"]).select(
        "row_key", (F.col("first") + F.col("from")).alias("first"), (F.col("first") + F.col("upto")).alias("last")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``row_key, doc_id, n_bytes, spans, kept``.

    ``spans`` are the byte ranges removed, none touching another; ``kept`` is the rest.
    """
    texts = stored.keyed(docs)
    found = repeated_windows(texts)
    marks = found.groupBy("row_key").agg(F.collect_set(F.struct("first", "last")).alias("marks"))
    joined = texts.join(marks, "row_key", "left").select("row_key", "doc_id", "text", "marks")
    kept = "row_key long, doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return joined.mapInArrow(_apply, kept)
