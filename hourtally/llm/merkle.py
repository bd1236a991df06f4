"""A Merkle manifest of a data set: a digest of every document, one of all, and proofs.

Every row of the documents is a leaf, the digest of its five columns. The leaves of one language,
by ``doc_id``, are the first level of its tree; every two nodes that follow each other become one,
an odd last node becomes one alone, until one is left, the subroot. The subroots, by language, are
the leaves of one more tree, whose last node is the root.

Trees are worked off in superblocks of ``2 ** LEVELS`` nodes. First every superblock is reduced to
its uppermost node, and these are nodes of the next, far smaller, stride. Then, from the top down, the
nodes of a superblock are cogrouped with the one row of outer nodes that all their proofs share;
one function reduces the superblock, joins local and outer siblings, and folds the leaves with them.
No task holds more than one superblock, no path is longer than the tree is high, and only the size of
the largest tree comes to the driver.

A null counts as ``-``; so does a null id, which comes first. Languages are ordered by their bytes, null first.
Repeated ids are ordered by their leaves; rows that are equal throughout are leaves of their own, all
with the same columns except the proofs of their own places. Empty texts are ``0:``. Long texts are hashed
whole. Without rows there is no tree and no result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtally.llm import stored

# Levels of a superblock, so 4,096 nodes of one pandas group.
LEVELS = 12
# The rows that are tampered with to show that proofs notice: ids with a crc32 divisible by this.
TAMPERED_EVERY = 7

NODE = "tree string, place long, total long, digest string"
PLACED = "tree string, place long, path array<string>, subroot string, root string"
PROVEN = (
    "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, otherwise the bytes of the value, a colon, and the value."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in (doc_id, source, lang, n_chars, text))).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, digest, tampered``: the leaf, and that of the row with one added to ``n_chars``.

    ``tampered`` is null for rows that nothing is done to. The tree is named by the language.
    """
    doc_id, n_chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    source, lang, text = (F.col(c).cast("string") for c in ("source", "lang", "text"))
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED_EVERY == 0
    more = n_chars.cast("decimal(20,0)") + 1
    return docs.select(
        F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("tree"),
        doc_id.alias("doc_id"),
        leaf_of(doc_id, source, lang, n_chars, text).alias("digest"),
        F.when(chosen & n_chars.isNotNull(), leaf_of(doc_id, source, lang, more, text)).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their ``place`` in their tree, from 0, and the ``total`` of the tree.

    Rows are dealt out by ranges and sorted there; the ranges' counts give where each begins. The order
    must end with a column that tells equal rows apart, so that they may be split too.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    marked = dealt.withColumns({"part": F.spark_partition_id(), "spot": F.monotonically_increasing_id()})
    marked = stored.written(marked, "ordered")
    counts = marked.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("spot").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("total"),
    )
    joined = marked.join(counts, ["tree", "part"])
    return joined.withColumn("place", F.col("spot") + F.col("shift")).drop("part", "spot", "shift")


def _levels(digests: list[str], total: int, most: int) -> list[list[str]]:
    """The nodes of a superblock, level by level, up to its uppermost node."""
    height = min(most, (total - 1).bit_length())
    out = [digests]
    for _ in range(height):
        low = out[-1]
        out.append([digest_of("".join(low[k : k + 2])) for k in range(0, len(low), 2)])
    return out


def _reduce(nodes: pd.DataFrame, most: int) -> pd.DataFrame:
    nodes = nodes.sort_values("place")
    total, place = int(nodes["total"].iloc[0]), int(nodes["place"].iloc[0])
    top = _levels(nodes["digest"].tolist(), total, most)[-1][0]
    above = -(-total // (1 << most))
    return pd.DataFrame({"tree": [nodes["tree"].iloc[0]], "place": [place >> most], "total": [above], "digest": [top]})


def _steps(levels: list[list[str]], k: int) -> list[str]:
    """The siblings of node ``k`` of the lowest level: ``<`` before it, ``>`` after it, or none."""
    out = []
    for low in levels[:-1]:
        if k % 2:
            out.append("<" + low[k - 1])
        elif k + 1 < len(low):
            out.append(">" + low[k + 1])
        else:
            out.append("")
        k //= 2
    return out


def folded(leaf: str, steps: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for step in steps:
        leaf = digest_of(step[1:] + leaf if step[:1] == "<" else leaf + step[1:])
    return leaf


def _nodes_of(nodes: pd.DataFrame, outer: pd.DataFrame, most: int):
    nodes = nodes.sort_values("place")
    levels = _levels(nodes["digest"].tolist(), int(nodes["total"].iloc[0]), most)
    shared = list(outer["path"].iloc[0])
    paths = [_steps(levels, k) + shared for k in range(len(nodes))]
    return nodes, paths, outer["subroot"].iloc[0], outer["root"].iloc[0]


def _place_below(nodes: pd.DataFrame, outer: pd.DataFrame, most: int) -> pd.DataFrame:
    """Inner nodes: what they hand on to the superblocks below them."""
    nodes, paths, subroot, root = _nodes_of(nodes, outer, most)
    return pd.DataFrame({"tree": nodes["tree"], "place": nodes["place"], "path": paths, "subroot": subroot, "root": root})


def _prove(nodes: pd.DataFrame, outer: pd.DataFrame, most: int) -> pd.DataFrame:
    """Leaves: proofs, and the root folded from what the rows hold now."""
    nodes, paths, subroot, root = _nodes_of(nodes, outer, most)
    now = nodes["tampered"].where(nodes["tampered"].notna(), nodes["digest"])
    found = [folded(leaf, steps) for leaf, steps in zip(now, paths, strict=True)]
    return pd.DataFrame(
        {
            "doc_id": nodes["doc_id"],
            "leaf": nodes["digest"],
            "subroot": subroot,
            "root": root,
            "proof_sha256": [digest_of("".join(step[1:] for step in steps)) for steps in paths],
            "folded_root": found,
            "verified": [x == root for x in found],
        }
    )


def _strides(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Nodes, the uppermost nodes of their superblocks, and so on until each tree has one node."""
    out = [nodes]
    largest = nodes.agg(F.max("total")).first()[0] or 0
    while largest > 1 or len(out) == 1:
        blocks = out[-1].select("tree", "place", "total", "digest").groupBy("tree", F.shiftright("place", most))
        out.append(stored.written(blocks.applyInPandas(lambda nodes: _reduce(nodes, most), NODE), "nodes"))
        largest = -(-largest // (1 << most))
    return out


def _exchanged(nodes: DataFrame, outer: DataFrame, most: int, finish, schema: str) -> DataFrame:
    """Superblocks together with the outer nodes that they need."""
    mine = nodes.withColumn("block", F.shiftright("place", most)).groupBy("tree", "block")
    theirs = outer.withColumnRenamed("place", "block").groupBy("tree", "block")
    return mine.cogroup(theirs).applyInPandas(lambda nodes, outer: finish(nodes, outer, most), schema)


def _below(strides: list[DataFrame], outer: DataFrame, most: int) -> DataFrame:
    """From the top down to the leaves: the outer nodes of the lowest superblocks."""
    for nodes in strides[-2:0:-1]:
        outer = stored.written(_exchanged(nodes, outer, most, _place_below, PLACED), "outer")
    return outer


def proofs(leaves: DataFrame, most: int = LEVELS) -> DataFrame:
    """Per leaf (``tree, doc_id, digest, tampered, row``) its digests, proof, and what it folds to.

    A superblock has ``most`` levels above its lowest one.
    """
    kept = stored.written(leaves, "leaves")
    text = F.col("doc_id").cast("string")
    nodes = placed(kept, "doc_id", "digest", "row").withColumn("doc_id", text).drop("row")
    strides = _strides(stored.written(nodes, "placed"), most)
    subroots = strides[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    trees = stored.written(placed(subroots, "name"), "subroots")
    upper = _strides(trees, most)
    top = upper[-1].select("tree", "place", F.array().cast("array<string>").alias("path"), F.col("digest").alias("subroot"))
    top = _below(upper, top.withColumn("root", F.col("subroot")), most)
    found = _exchanged(trees, top, most, _place_below, PLACED)
    named = found.join(trees.select("place", "name", "digest"), "place")
    start = F.lit(0).cast("long").alias("place")
    outer = named.select(F.col("name").alias("tree"), start, "path", F.col("digest").alias("subroot"), "root")
    outer = _below(strides, stored.written(outer, "outer"), most)
    return _exchanged(strides[0], outer, most, _prove, PROVEN).withColumn("doc_id", F.col("doc_id").cast("long"))


def manifest(docs: DataFrame, most: int = LEVELS) -> DataFrame:
    """Documents (``doc_id, source, lang, n_chars, text``) to their digests and proofs."""
    return proofs(leaves(docs), most)
