from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourtally.llm import graph, minhash, registered, textbytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) >= 5:
        return frozenset(zip(*(found[i:] for i in range(5)), strict=False))
    return frozenset([tuple(found)]) if found else frozenset()


def by_hand(rows):
    """Size of the set and smallest linked id of every row."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
            root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted((d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows) if d is not None)


def found_rows(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect() if r.doc_id is not None)


def test_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = registered.op8_minhash_near_dedup(spark, sf_dir)
    assert found_rows(found) == by_hand(rows)
    assert found.where(F.col("kept") != (F.col("doc_id") == F.col("component_id"))).count() == 0


def test_groups_larger_than_a_task_compares(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TOGETHER", 8)
    draw = random.Random(3)
    original = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(original))]
    for doc_id in range(1, 60):
        words = list(original)
        for _ in range(draw.choice([1, 2, 3])):
            words[draw.randrange(120)] = f"x{doc_id}"
        rows.append((doc_id, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(100 + i, passage + " " + " ".join(f"q{i}.{k}" for k in range(60))) for i in range(60)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found_rows(found) == by_hand(rows)


def edited_copies(count, length, edits, seed):
    draw = random.Random(seed)
    rows = []
    for doc_id in range(count):
        words = [f"w{i}" for i in range(length)]
        for at in draw.sample(range(length), draw.choice(edits)):
            words[at] = f"x{doc_id}.{at}"
        rows.append((doc_id, " ".join(words)))
    return rows


@pytest.mark.parametrize("together", [512, 40])
def test_few_links_among_many_alike(spark, monkeypatch, together):
    """Most pairs are a little too different to link, and look as alike as those that do."""
    monkeypatch.setattr(minhash, "TOGETHER", together)
    rows = edited_copies(300, 120, (2,), 5)
    sets = [shingles(text) for _, text in rows]
    alike = [len(x & y) / len(x | y) for x, y in combinations(sets, 2)]
    assert 0.70 <= sum(alike) / len(alike) <= 0.74
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found_rows(found) == by_hand(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = minhash.near_duplicates(odd_docs)
    assert found_rows(found) == by_hand(rows)
    assert found.count() == len(rows)
    kept = minhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    # one of the repeated rows goes, rows without words stay
    assert kept.count() == len(rows) - 1
    assert minhash.near_duplicates(no_docs).count() == minhash.deduplicated(no_docs).count() == 0


def test_coordinates_estimate_similarity():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 1 << 63, 1200).astype(np.uint64)
    one, two = minhash.signature(values[:1000]), minhash.signature(values[200:])
    assert abs((one == two).mean() - 800 / 1200) < 0.15
    assert len(np.unique(one)) > minhash.COORDINATES * 0.9


@pytest.mark.parametrize("size", [1, 60, 1 << 21])
def test_blocks_do_not_matter(size):
    import pyarrow as pa

    texts = ["A b c d e f", None, "", "x", "one TWO three four five\nsix", "  a  "]
    found = [s.tolist() for b in textbytes.blocks(pa.array(texts), size) for s in textbytes.shingle_sets(b)]
    assert [len(x) for x in found] == [len(shingles(t)) for t in texts]
    lower = [s.tolist() for b in textbytes.blocks(pa.array([(t or "").lower() for t in texts])) for s in textbytes.shingle_sets(b)]
    assert found == lower


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 150)] + [(200, 201), (201, 200), (7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in graph.components(frame).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 201: 200}
    assert graph.components(frame.where("1 = 0")).count() == 0


@pytest.mark.parametrize("count", [100, 400, 800])
def test_links_do_not_grow_with_pairs(spark, monkeypatch, count):
    monkeypatch.setattr(minhash, "TOGETHER", 128)
    rows = edited_copies(count, 120, (2,), 7)
    docs = minhash.stored.keyed(spark.createDataFrame(rows, "doc_id long, text string"))
    signed = minhash.stored.written(docs.mapInArrow(minhash._sign, minhash.SIGNED), "signatures")
    shown = minhash.representatives(signed)
    near = minhash.neighbourhoods(shown)
    assert near.count() <= count
    texts = docs.select("row_key", "text")
    held = minhash.in_blocks(near, shown, texts)
    inside = held.sortWithinPartitions("component", "block").coalesce(1).mapInArrow(
        minhash._confirmed, "component long, block int, blocks int, node long, class long"
    )
    assert minhash.across_blocks(inside, held, shown).count() < count * (1 + count / 128)
    assert minhash.classes_of(shown, texts).count() <= count
    assert found_rows(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == by_hand(rows)


@pytest.mark.parametrize("sizes", [(3, 4), (40, 30), (200, 1)])
def test_sizes_of_intersections(sizes):
    draw = np.random.default_rng(2)
    some, others = ([np.unique(draw.integers(0, 60, draw.integers(1, 50)).astype(np.uint64)) for _ in range(n)] for n in sizes)
    wanted = [[len(set(x.tolist()) & set(y.tolist())) for y in others] for x in some]
    assert minhash.common_sizes(some, others).tolist() == wanted
    apart = [x + np.uint64(1000) for x in others]
    assert not minhash.common_sizes(some, apart).any()
