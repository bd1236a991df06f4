"""Benchmark items in documents, with a share of errors allowed.

Of an item cut into one piece more than the errors allowed, at least one piece is found
unchanged wherever the item is. So documents are searched for all pieces at once; where
one is found, the text around it is checked: first by counting common runs of ``GRAM``
characters (each error spoils so many at most), then by Myers' bit-parallel edit distance.

Texts are compared as lower-case letters and digits, with one blank for each run of all else.
An item without either is found nowhere, and one of a few letters wherever they stand, within words too (an
item "a" is in every text with an a); null and empty texts hold nothing. Very long texts are searched whole. The errors
allowed are ``ERROR_SHARE`` of an item's length so written, rounded down. Repeated rows and
repeated items are reported each for itself; extra columns are ignored.

Items are broadcast in blocks of a set size, one pass over the documents for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_SHARE = 0.1
# Characters of items in a block, and of texts looked at together.
ITEM_BLOCK = 4_000_000
TEXT_BLOCK = 1 << 20

GRAM = 5

BLANK = 32
PARTING = 10


@cache
def _written() -> np.ndarray:
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def plain(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts as compared, each text's end, and the places they came from."""
    lowered = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "replace"), np.uint32)
    kept = _written()[points]
    out = np.where(kept, points, np.uint32(BLANK))
    ends = np.cumsum(sizes) - 1
    out[ends] = PARTING
    keep = kept.copy()
    keep[1:] |= kept[:-1]
    keep[ends] = True
    places = np.flatnonzero(keep)
    return out[places], np.searchsorted(places, ends), places


def distance(item: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance of the item to any part of the text, and where that part ends
    (the first such end). Myers' bit vectors, one word of the item's length."""
    masks: dict[int, int] = {}
    for i, point in enumerate(item):
        masks[point] = masks.get(point, 0) | 1 << i
    every, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score = every, 0, len(item)
    least, end = score, 0
    for at, point in enumerate(text, start=1):
        equal = masks.get(point, 0)
        straight = (((equal & up) + up) ^ up) | equal | down
        right_up = down | ~(straight | up) & every
        right_down = up & straight
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = right_up << 1 & every
        right_down = right_down << 1 & every
        up = right_down | ~(straight | right_up) & every
        down = right_up & straight
        if score < least:
            least, end = score, at
    return least, end


class Items(NamedTuple):
    ids: list[int]
    points: list[np.ndarray]
    budgets: np.ndarray
    sizes: np.ndarray
    finder: ahocorasick.Automaton
    owners: list[list[tuple[int, int]]]
    grams: np.ndarray


def _grams(points: np.ndarray) -> np.ndarray:
    """A 15-bit hash of every run of ``GRAM`` characters."""
    count = len(points) - GRAM + 1
    out = np.zeros(count, np.uint32)
    for k in range(GRAM):
        out = (out ^ points[k : k + count]) * np.uint32(0x9E3779B1)
    return (out >> np.uint32(17)).astype(np.int64)


def prepare(items: list[tuple[int, str]], share: float = ERROR_SHARE) -> Items | None:
    """What a task needs to find some items; None if there is nothing to find."""
    points, ends, _ = plain([text for _, text in items])
    begin = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    ids, parts = [], []
    for (item_id, _), a, b in zip(items, begin.tolist(), ends.tolist(), strict=True):
        part = points[a:b]
        part = part[:-1] if len(part) and part[-1] == BLANK else part
        if len(part):
            ids.append(item_id)
            parts.append(part)
    if not ids:
        return None
    sizes = np.array([len(p) for p in parts])
    budgets = np.floor(sizes * share).astype(np.int64)
    finder, owners = ahocorasick.Automaton(), []
    bits = np.zeros(len(parts) * (1 << 12), np.uint8)
    for i, part in enumerate(parts):
        text = part.astype(np.uint32).tobytes().decode("utf-32-le")
        cuts = [len(text) * k // (int(budgets[i]) + 1) for k in range(int(budgets[i]) + 2)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            number = finder.get(text[a:b], None)
            if number is None:
                number = (len(owners), b - a)
                owners.append([])
                finder.add_word(text[a:b], number)
            owners[number[0]].append((i, a))
        if len(part) >= GRAM:
            gram = _grams(part) + i * (1 << 15)
            np.bitwise_or.at(bits, gram >> 3, np.uint8(1) << (gram & 7).astype(np.uint8))
    finder.make_automaton()
    return Items(ids, parts, budgets, sizes, finder, owners, bits)


class Match(NamedTuple):
    text: int
    item: int
    distance: int
    start: int
    end: int


def _candidates(items: Items, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places to check: item, first and last place, none across two texts."""
    joined = points.tobytes().decode("utf-32-le")
    which, at = [], []
    for end, (number, size) in items.finder.iter(joined):
        start = end - size + 1
        for item, offset in items.owners[number]:
            which.append(item)
            at.append(start - offset)
    item, shift = np.array(which, np.int64), np.array(at, np.int64)
    step = np.maximum(1, items.budgets[item])
    text = np.searchsorted(ends, np.maximum(shift, 0) + items.sizes[item] // 2)
    text = np.minimum(text, len(ends) - 1)
    spot = np.unique(np.stack([item, shift // step]), axis=1) if len(item) else np.zeros((2, 0), np.int64)
    item, step = spot[0], np.maximum(1, items.budgets[spot[0]])
    first = spot[1] * step - items.budgets[item]
    last = (spot[1] + 1) * step + items.sizes[item] + items.budgets[item]
    return item, np.maximum(first, 0), np.minimum(last, len(points))


def _promising(items: Items, points: np.ndarray, item, first, last) -> np.ndarray:
    """Candidates with as many common runs as the errors allowed must leave."""
    if len(points) < GRAM or not len(item):
        return np.ones(len(item), bool)
    grams = _grams(points)
    need = items.sizes[item] - (GRAM - 1) - GRAM * items.budgets[item]
    counts = np.maximum(0, np.minimum(last - GRAM + 1, len(grams)) - first)
    out = need <= 0
    for a in range(0, len(item), 4096):
        n = counts[a : a + 4096]
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[a : a + 4096], n)
        bit = grams[at] + (item[a : a + 4096] << 15)[row]
        common = np.bincount(row, items.grams[bit >> 3] >> (bit & 7).astype(np.uint8) & 1, len(n))
        out[a : a + 4096] |= common >= need[a : a + 4096]
    return out


def find(items: Items, texts: list[str | None]) -> list[Match]:
    """The best place of each item in each text that holds it, as characters ``start`` to
    ``end`` of the lower-case text."""
    points, ends, places = plain(texts)
    begins = np.concatenate([[0], ends[:-1] + 1])
    origin = np.concatenate([[0], places[ends[:-1]] + 1])
    item, first, last = _candidates(items, points, ends)
    good = _promising(items, points, item, first, last)
    best: dict[tuple[int, int], Match] = {}
    for i, a, b in zip(item[good].tolist(), first[good].tolist(), last[good].tolist(), strict=True):
        # a place may reach into the texts around: each text's part is checked by itself
        for text in range(int(np.searchsorted(ends, a)), min(int(np.searchsorted(ends, b)) + 1, len(ends))):
            lo, hi = max(a, int(begins[text])), min(b, int(ends[text]))
            if hi - lo < items.sizes[i] - items.budgets[i]:
                continue
            part, wanted = points[lo:hi].tolist(), items.points[i].tolist()
            errors, end = distance(wanted, part)
            known = best.get((text, i))
            if errors > items.budgets[i] or (known is not None and known.distance <= errors):
                continue
            back = distance(wanted[::-1], part[:end][::-1])[1]
            start, stop = places[lo + end - back] - origin[text], places[lo + end - 1] + 1 - origin[text]
            best[text, i] = Match(text, i, errors, int(start), int(stop))
    return [best[k] for k in sorted(best)]


@cache
def _prepared(shipped) -> Items | None:
    return prepare(shipped.value)


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto] or "") < TEXT_BLOCK):
            size += len(texts[upto] or "")
            upto += 1
        yield at, upto
        at = upto


def _found(shipped, texts: list[str | None]) -> Iterator[Match]:
    items = _prepared(shipped)
    if items is not None:
        for at, upto in _runs(texts):
            for match in find(items, texts[at:upto]):
                yield match._replace(text=at + match.text)


def item_blocks(benchmark: DataFrame) -> list:
    """The items (``item_id, text``) as broadcasts of about ``ITEM_BLOCK`` characters each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    number = -(-total // ITEM_BLOCK)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, number)))
    out = []
    for k in range(number):
        rows = items.where(block == k).collect()  # about ITEM_BLOCK characters
        out.append(spark.sparkContext.broadcast(sorted((-1 if r[0] is None else r[0], r[1]) for r in rows)))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, distance, start, end``: every item that a document holds."""
    kind = "doc_id long, item_id long, distance int, start long, end long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def search(shipped):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(_found(shipped, batch.column("text").to_pylist()))
                ids = _prepared(shipped).ids if found else []
                columns = [batch.column("doc_id").take(pa.array([m.text for m in found], pa.int64()))]
                columns.append(pa.array([ids[m.item] for m in found], pa.int64()))
                columns.append(pa.array([m.distance for m in found], pa.int32()))
                columns.extend(pa.array([getattr(m, n) for m in found], pa.int64()) for n in ("start", "end"))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "distance", "start", "end"])

        return rows.mapInArrow(run, kind)

    parts = [search(shipped) for shipped in item_blocks(benchmark)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], kind)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no item, with all their columns."""

    def clean(shipped):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = np.zeros(batch.num_rows, bool)
                hit[[m.text for m in _found(shipped, batch.column("text").to_pylist())]] = True
                yield batch.filter(pa.array(~hit))

        return run

    for shipped in item_blocks(benchmark):
        docs = docs.mapInArrow(clean(shipped), docs.schema)
    return docs
