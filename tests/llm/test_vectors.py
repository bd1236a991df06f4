from __future__ import annotations

import numpy as np
import pytest

from hourtally.llm import vectors

KIND = "vec_id long, embedding array<float>, node string, n string"


def by_hand(rows, least=0.95):
    good = []
    for i, (_, v) in enumerate(rows):
        sound = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if sound else None)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for i, a in enumerate(good):
        for j in range(i):
            b = good[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= least:
                n[i] += 1
                n[j] += 1
                root[top(i)] = top(j)
    lowest = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            lowest[top(i)] = min(k, lowest.get(top(i), k))
    return sorted((k, n[i], lowest[top(i)]) for i, (k, _) in enumerate(rows) if k is not None)


def planted():
    draw = np.random.default_rng(4)
    rows = [draw.normal(size=16) for _ in range(150)]
    for k in range(5):
        centre = draw.normal(size=16)
        rows += [centre + draw.normal(size=16) * 0.12 * k * np.linalg.norm(centre) / 8 for _ in range(60)]
    rows += [rows[3], rows[3], rows[3] * 2, rows[4] * 1e-20, rows[5] * 1e20]
    rows = [[float(np.float32(x)) for x in v] for v in rows]
    return list(enumerate(rows))


ODD = [
    (900, None), (901, []), (902, [0.0] * 16), (903, [1.0] * 15 + [None]), (904, [float("nan")] * 16), (905, [float("inf")] * 16),
    (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, [1.0, 2.0]), (906, [1.0, 2.0]), (None, None),
]


@pytest.mark.parametrize("block", [1024, 16])
def test_against_every_pair(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "LIST_SIZE", 40)
    monkeypatch.setattr(vectors, "QUERIES", 50)
    rows = planted() + ODD
    frame = spark.createDataFrame([(k, v, "x", "y") for k, v in rows], KIND)
    found = sorted(tuple(r) for r in vectors.near_duplicates(frame).collect() if r.vec_id is not None)
    assert found == by_hand(rows)


def test_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], KIND)).count() == 0


def test_probes_reach_every_neighbour():
    draw = np.random.default_rng(8)
    points = draw.normal(size=(600, 24))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    near = points + draw.normal(size=points.shape) * 0.05
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    index = vectors.fit(points, 40_000)
    own, _, _ = vectors.coded(index, points)
    other, codes, left = vectors.coded(index, near)
    linked = (points * near).sum(axis=1) >= 0.95
    assert linked.sum() > 100
    assert vectors.probed(index, points, own, np.sqrt(0.1))[np.arange(600), other][linked].all()
    rest = near - index.centres[other]
    read = np.concatenate([book[codes[:, m]] for m, book in enumerate(index.books)], axis=1)
    assert np.allclose(np.linalg.norm(rest - read, axis=1), left)


@pytest.mark.parametrize(("probes", "least_found"), [(vectors.PROBES, 0.95), (None, 1.0)])
def test_links_found_among_many_lists(spark, monkeypatch, probes, least_found):
    """Pairs at little more than the least cosine, in 90 lists: the hardest that there are."""
    monkeypatch.setattr(vectors, "LIST_SIZE", 40)
    draw = np.random.default_rng(12)
    base = draw.normal(size=(1800, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = draw.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = 0.9505 * base + np.sqrt(1 - 0.9505**2) * side
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, near]))]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), probes=probes).collect()
    linked = [r for r in found if r.n_links]
    assert len(linked) >= least_found * len(rows)
    assert all(r.component_id == r.vec_id % 1800 for r in linked)


def test_rows_dealt_do_not_grow_with_lists():
    draw = np.random.default_rng(13)
    points = draw.normal(size=(3000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    for total in (30_000, 150_000):
        index = vectors.fit(points, total)
        own, _, _ = vectors.coded(index, points[:500])
        assert vectors.probed(index, points[:500], own, np.sqrt(0.1), vectors.PROBES).sum(axis=1).max() <= vectors.PROBES


def test_query_by_hand(spark, tmp_path):
    from hourtally.llm import registered

    rows = planted()
    spark.createDataFrame([(k, v, 0) for k, v in rows], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = registered.queries()["op9_product_quantised_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == by_hand(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
