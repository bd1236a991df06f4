"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct 5-word shingles. Two permutations of the 32-bit
numbers make all coordinates of its signature: the first is applied once, the second is
shifted around by one place more for every coordinate. Bands of four coordinates bring
candidates together (at the least similarity that links, 0.75, all 32 bands fail for
about 5 pairs in a million).

Signatures and sizes join the members of buckets to components that hold all that may link. Then every
component gets the texts of its members once, and one task confirms all of them on their full sets. A component too
large for a task is dealt out in blocks; after each has been confirmed, members outside the component's largest
class are held against the other blocks, first by signatures, then by full sets. No pair leaves a task
unless it links, and then only if it connects what was not connected there; so there are always
fewer links than members, however many texts are alike without linking.

Nulls and empty texts have no set and link with nothing. Rows with equal sets are one
class before any comparison, however many they are. Repeated rows and repeated ids are
rows of their own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtally.llm import graph, stored, textbytes

BANDS = 32
ROWS = 4
COORDINATES = BANDS * ROWS
# Members of a bucket or of a block that one task compares with each other, and shingles of a block.
TOGETHER = 512
SHINGLES = 1 << 22
# A link shows at least this share of equal coordinates: six standard deviations below
# the least similarity that links.
LEAST_SEEN = 0.52

SIGNED = "row_key long, doc_id long, n_shingles long, set_1 long, set_2 long, bands array<long>, coords binary"


def _second_permutation(values: np.ndarray) -> np.ndarray:
    """A bijection of the 32-bit numbers."""
    values ^= values >> np.uint32(16)
    values *= np.uint32(0x85EBCA6B)
    values ^= values >> np.uint32(13)
    values *= np.uint32(0xC2B2AE35)
    values ^= values >> np.uint32(16)
    return values


def signature(shingles: np.ndarray) -> np.ndarray:
    """The coordinates of a set: minima of the second permutation, shifted further each time."""
    shifts = np.arange(COORDINATES, dtype=np.uint32)
    first = (textbytes.mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, np.uint32(0xFFFFFFFF))
    for at in range(0, len(first), 512):
        values = _second_permutation(first[at : at + 512, None] - shifts[None, :])
        np.minimum(least, values.min(axis=0), out=least)
    return least


def _band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = textbytes.mix(key ^ rows[:, k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, one, two, bands, coords = [], [], [], [], []
        for block in textbytes.blocks(batch.column("text")):
            for shingles in textbytes.shingle_sets(block):
                sizes.append(len(shingles))
                one.append(int(shingles.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(np.bitwise_xor.reduce(textbytes.mix(shingles)).view(np.int64)) if len(shingles) else 0)
                if len(shingles):
                    coordinates = signature(shingles)
                    bands.append(_band_keys(coordinates))
                    coords.append(coordinates.astype(np.uint8).tobytes())
                else:
                    bands.append([])
                    coords.append(b"")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_key"),
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(one, pa.int64()),
                pa.array(two, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(coords, pa.binary()),
            ],
            names=["row_key", "doc_id", "n_shingles", "set_1", "set_2", "bands", "coords"],
        )


def _spanning(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that connect all that is near, fewer than members; ``near(i, others)`` says which are."""
    left = np.arange(count)
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = near(i, left)
            if hit.any():
                for j in left[hit].tolist():
                    yield i, j
                    queue.append(j)
                left = left[~hit]


def _may_link(coords: np.ndarray, sizes: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Which of others may link with member ``i``: sizes are not too different, nor are signatures."""
    fits = (4 * sizes[others] >= 3 * sizes[i]) & (4 * sizes[i] >= 3 * sizes[others])
    fits[fits] = (coords[others[fits]] == coords[i]).sum(axis=1) >= LEAST_SEEN * COORDINATES
    return fits


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Rows come sorted by keys; batches of whole groups, and where each group begins (and the last ends)."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        spot = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        edges = np.flatnonzero((spot[1:] != spot[:-1]).any(axis=1)) + 1
        if len(edges):
            yield batch.slice(0, int(edges[-1])), [0, *edges.tolist()]
            held = batch.slice(int(edges[-1]))
        else:
            held = batch
    if held is not None:
        yield held, [0, held.num_rows]


def _signed_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets, one after another, to links that connect what may link in each."""
    for batch, bounds in _groups(batches, ("key",)):
        nodes, sizes = batch.column("node").to_numpy(), batch.column("n_shingles").to_numpy()
        coords = np.frombuffer(b"".join(batch.column("coords").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        first, count = np.array(bounds[:-1]), np.diff(bounds)
        two = first[count == 2]
        fits = (4 * sizes[two] >= 3 * sizes[two + 1]) & (4 * sizes[two + 1] >= 3 * sizes[two])
        two = two[fits & ((coords[two] == coords[two + 1]).sum(axis=1) >= LEAST_SEEN * COORDINATES)]
        a, b = [nodes[two]], [nodes[two + 1]]
        for lo, n in zip(first[count > 2].tolist(), count[count > 2].tolist(), strict=True):
            some, size, mine = coords[lo : lo + n], sizes[lo : lo + n], nodes[lo : lo + n]
            found = list(_spanning(n, lambda i, others, c=some, s=size: _may_link(c, s, i, others)))
            a.append(mine[[i for i, _ in found]])
            b.append(mine[[j for _, j in found]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def common_sizes(some: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of sorted sets of one list with those of another."""
    out = np.zeros((len(some), len(others)), np.float64)
    if len(some) * len(others) <= 64:
        for i, x in enumerate(some):
            for j, y in enumerate(others):
                out[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        return out
    theirs = np.concatenate(others)
    values, theirs = np.unique(theirs, return_inverse=True)
    mine = np.concatenate(some)
    place = np.minimum(np.searchsorted(values, mine), len(values) - 1)
    known = values[place] == mine
    row, place = np.repeat(np.arange(len(some)), [len(x) for x in some])[known], place[known]
    # Only what both lists hold counts; it is taken in so many columns at a time.
    both, place = np.unique(place, return_inverse=True)
    column = np.minimum(np.searchsorted(both, theirs), max(0, len(both) - 1))
    shared = both[column] == theirs if len(both) else np.zeros(len(theirs), bool)
    owner, column = np.repeat(np.arange(len(others)), [len(y) for y in others])[shared], column[shared]
    mine_order, their_order = np.argsort(place, kind="stable"), np.argsort(column, kind="stable")
    row, place, owner, column = row[mine_order], place[mine_order], owner[their_order], column[their_order]
    width = max(64, (1 << 22) // (len(some) + len(others)))
    for lo in range(0, len(both), width):
        parts = []
        for size, who, what in ((len(some), row, place), (len(others), owner, column)):
            at, upto = np.searchsorted(what, [lo, lo + width])
            part = np.zeros((size, min(width, len(both) - lo)), np.float32)
            part[who[at:upto], what[at:upto] - lo] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def links_between(some: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Which sets of one list link with which of another."""
    common = common_sizes(some, others)
    sizes = np.array([len(x) for x in some])[:, None] + np.array([len(y) for y in others])[None, :]
    return 100 * common >= 75 * (sizes - common)


def _sets_of(texts: pa.Array) -> list[np.ndarray]:
    return [s for block in textbytes.blocks(texts) for s in textbytes.shingle_sets(block)]


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts, one after another, to the classes that confirmed links make of their members."""
    for batch, bounds in _groups(batches, ("component", "block")):
        nodes = batch.column("node").to_numpy()
        classes = nodes.copy()
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            sets = _sets_of(batch.column("text").slice(lo, hi - lo))
            linked = links_between(sets, sets)
            top = np.arange(hi - lo)
            for i, j in _spanning(hi - lo, lambda i, others, m=linked: m[i, others]):
                top[j] = top[i]  # trees are given from their roots on
            least = np.full(hi - lo, np.iinfo(np.int64).max)
            np.minimum.at(least, top, nodes[lo:hi])
            classes[lo:hi] = least[top]
        columns = [*(batch.column(n) for n in ("component", "block", "blocks", "node")), pa.array(classes)]
        yield pa.RecordBatch.from_arrays(columns, names=["component", "block", "blocks", "node", "class"])


def _with_members(batches: Iterator[pa.RecordBatch], read) -> Iterator[tuple[tuple, tuple, list]]:
    """Rows come sorted by component, block and role: the members of each block, and batches of its queries.

    ``read(batch)`` gives columns, lists or arrays, of which the first two are nodes and classes.
    """
    place, parts, members = None, [], None
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            spot = np.stack([batch.column(k).to_numpy() for k in ("component", "block", "role")], axis=1)
            edges = np.flatnonzero((spot[1:] != spot[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(spot)], strict=True):
                here, columns = (int(spot[lo, 0]), int(spot[lo, 1])), read(batch.slice(lo, hi - lo))
                if here != place:
                    place, parts, members = here, [], None
                if spot[lo, 2] == 0:
                    parts.append(columns)
                elif parts:
                    if members is None:
                        members = [sum(c, []) if isinstance(c[0], list) else np.concatenate(c) for c in zip(*parts, strict=True)]
                    yield here, members, columns


def _read_signed(batch: pa.RecordBatch) -> list:
    coords = np.frombuffer(b"".join(batch.column("coords").to_pylist()), np.uint8).reshape(-1, COORDINATES)
    return [*(batch.column(n).to_numpy() for n in ("node", "class", "n_shingles")), coords]


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks in which a query may link with a member of another class."""
    for here, members, queries in _with_members(batches, _read_signed):
        found = []
        for node, own, size, coords in zip(*queries, strict=True):
            others = np.flatnonzero((members[1] != own) & (4 * members[2] >= 3 * size) & (4 * size >= 3 * members[2]))
            if ((members[3][others] == coords).sum(axis=1) >= LEAST_SEEN * COORDINATES).any():
                found.append(int(node))
        places = [pa.array([v] * len(found), k) for v, k in zip(here, (pa.int64(), pa.int32()), strict=True)]
        yield pa.RecordBatch.from_arrays([*places, pa.array(found, pa.int64())], names=["component", "block", "node"])


def _confirmed_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries against the members of blocks: classes that confirmed links connect."""
    place, top = None, {}

    def root(k: int) -> int:
        while top.get(k, k) != k:
            k = top[k]
        return k

    def read(batch: pa.RecordBatch) -> list:
        return [batch.column("node").to_numpy(), batch.column("class").to_numpy(), _sets_of(batch.column("text"))]

    for here, members, queries in _with_members(batches, read):
        if here != place:
            place, top = here, {}
        a, b = [], []
        linked = links_between(queries[2], members[2]) & (queries[1][:, None] != members[1][None, :])
        for i, j in np.argwhere(linked).tolist():
            one, two = root(int(queries[1][i])), root(int(members[1][j]))
            if one != two:
                top[one] = two
                a.append(int(queries[1][i]))
                b.append(int(members[1][j]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def representatives(signed: DataFrame) -> DataFrame:
    """One row of each set: ``node, set_1, set_2, n_shingles, least`` (the smallest id), ``bands, coords``."""
    sets = signed.where("n_shingles > 0").groupBy("set_1", "set_2", "n_shingles")
    shown = sets.agg(
        F.min("row_key").alias("node"), F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("coords").alias("coords")
    )
    return stored.written(shown, "sets")


def neighbourhoods(shown: DataFrame) -> DataFrame:
    """``node, component`` of all sets that may link with another one: what may link is in one component.

    In a bucket of up to ``TOGETHER`` members signatures tell what may link; the members of a larger
    one go together. Only links that span a bucket leave it.
    """
    bands = shown.select("node", F.explode("bands").alias("key"))
    sizes = stored.written(bands.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1"), "buckets")
    # Both sides grow with the documents, so neither is broadcast at any size.
    members = stored.written(bands.join(sizes.hint("merge"), "key").select("key", "node", "size", "hub"), "members")
    small = members.where(F.col("size") <= TOGETHER).select("key", "node")
    signed = small.join(shown.select("node", "n_shingles", "coords").hint("merge"), "node")
    dealt = signed.select("key", "node", "n_shingles", "coords").repartition("key").sortWithinPartitions("key")
    alike = dealt.mapInArrow(_signed_alike, "a long, b long")
    together = members.where((F.col("size") > TOGETHER) & (F.col("node") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    joined = stored.written(alike.unionAll(together), "alike")
    stored.released(sizes, members)
    found = graph.components(joined)
    stored.released(joined)
    return found


def in_blocks(near: DataFrame, shown: DataFrame, texts: DataFrame) -> DataFrame:
    """``component, block, blocks, node, text``: components in blocks that one task confirms at a time."""
    placed = near.join(shown.select("node", "n_shingles").hint("merge"), "node")
    placed = stored.written(placed, "placed")
    many = F.greatest(F.ceil(F.count("*") / TOGETHER), F.ceil(F.sum("n_shingles") / SHINGLES)).cast("int")
    counts = placed.groupBy("component").agg(many.alias("blocks"))
    placed = placed.join(counts.hint("merge"), "component")
    block = F.pmod(F.xxhash64("component", "node"), F.col("blocks")).cast("int").alias("block")
    placed = placed.select("component", block, "blocks", "node").hint("merge")
    held = texts.join(placed, F.col("row_key") == F.col("node")).dropDuplicates(["row_key"])
    return stored.written(held.select("component", "block", "blocks", "node", "text"), "blocks")


def across_blocks(inside: DataFrame, held: DataFrame, shown: DataFrame) -> DataFrame:
    """``a, b``: classes of different blocks of a component that are linked, given the classes inside blocks.

    What is connected is never compared again: members outside a component's largest class are
    held against all other blocks, by signatures, then, where one may link, by texts.
    """
    large = inside.where("blocks > 1")
    counts = large.groupBy("component", "class").agg(F.count("*").alias("n"))
    main = counts.groupBy("component").agg(F.max(F.struct("n", "class")).alias("top"), F.count("*").alias("classes"))
    main = main.where("classes > 1").select("component", F.col("top.class").alias("main"))
    several = large.join(main.hint("merge"), "component").join(shown.select("node", "n_shingles", "coords").hint("merge"), "node")
    several = stored.written(several, "several")
    columns = ("node", "class", "n_shingles", "coords")
    as_member = several.select("component", "block", F.lit(0).alias("role"), *columns)
    elsewhere = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("block"))
    outside = several.where(F.col("class") != F.col("main"))
    as_query = outside.select("component", F.explode(elsewhere).alias("block"), F.lit(1).alias("role"), *columns)
    met = as_member.unionAll(as_query).repartition("component", "block").sortWithinPartitions("component", "block", "role")
    reached = stored.written(met.mapInArrow(_reached, "component long, block int, node long"), "reached")
    texts = held.where("blocks > 1").select("node", "text")
    labelled = several.select("component", "block", "node", "class").join(texts.hint("merge"), "node")
    labelled = stored.written(labelled, "labelled")
    queries = reached.join(labelled.select("node", "class", "text").hint("merge"), "node")
    touched = reached.select("component", "block").distinct().hint("merge")
    members = labelled.join(touched, ["component", "block"])
    columns = ("node", "class", "text")
    as_member = members.select("component", "block", F.lit(0).alias("role"), *columns)
    as_query = queries.select("component", "block", F.lit(1).alias("role"), *columns)
    met = as_member.unionAll(as_query).repartition("component", "block").sortWithinPartitions("component", "block", "role")
    return met.mapInArrow(_confirmed_across, "a long, b long")


def classes_of(shown: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, class`` of the representatives that may link; those of one class are connected by links."""
    held = in_blocks(neighbourhoods(shown), shown, texts)
    dealt = held.repartition("component", "block").sortWithinPartitions("component", "block")
    inside = dealt.mapInArrow(_confirmed, "component long, block int, blocks int, node long, class long")
    inside = stored.written(inside, "inside")
    if inside.where("blocks > 1").isEmpty():
        stored.released(held)
        return inside.select("node", "class")
    links = stored.written(across_blocks(inside, held, shown), "links")
    stored.released(held)
    joined = graph.components(links).select(F.col("node").alias("class"), "component").hint("merge")
    named = inside.select("node", "class").join(joined, "class", "left")
    return named.select("node", F.coalesce("component", "class").alias("class"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``row_key, doc_id, n_shingles, component_id, class``.

    The component is the smallest id reachable by links; a null id is never the smallest
    unless all are null. The class numbers groups; it is null for rows without words.
    """
    texts = stored.keyed(docs)
    signed = stored.written(texts.mapInArrow(_sign, SIGNED), "signatures")
    shown = representatives(signed)
    classes = classes_of(shown, texts.select("row_key", "text"))
    sets = shown.select("set_1", "set_2", "n_shingles", "node", "least").join(classes.hint("merge"), "node", "left")
    sets = sets.withColumn("class", F.coalesce("class", "node"))
    sets = stored.written(sets.select("set_1", "set_2", "n_shingles", "class", "least"), "sets")
    stored.released(shown)
    lowest = sets.groupBy("class").agg(F.min("least").alias("component_id"))
    # Written, so that Spark may split a join with very many rows of one set.
    named = stored.written(sets.join(lowest, "class").drop("least"), "classes")
    rows = signed.select("row_key", "doc_id", "n_shingles", "set_1", "set_2")
    joined = rows.join(named, ["set_1", "set_2", "n_shingles"], "left")
    component = F.coalesce("component_id", "doc_id").alias("component_id")
    return joined.select("row_key", "doc_id", "n_shingles", component, "class")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows with all their columns, but one of each group: the one of smallest id.

    Rows without words are in no group and all stay.
    """
    found = stored.written(near_duplicates(docs).select("row_key", "doc_id", "class"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")
    best = found.where("class IS NOT NULL").groupBy("class").agg(first).select("first.row_key", F.lit(False).alias("all"))
    loose = found.where("class IS NULL").select("row_key", F.lit(True).alias("all")).distinct()
    rows = docs.select(F.struct("*").alias("row")).withColumn("row_key", stored.key_of("row.doc_id", "row.text"))
    kept = rows.join(best.unionAll(loose), "row_key")
    again = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    return kept.withColumn("again", again).where("all OR again = 1").select("row.*")
