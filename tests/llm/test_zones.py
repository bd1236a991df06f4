from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np

from hourtally.llm import oracles, registered, zones

KIND = "vec_id long, embedding array<double>, cluster string, distance string, x string, row string"


def whole(v):
    return [int(x) * 256 if abs(x) >= 2.0**53 else math.floor(256 * x) for x in v]


def by_hand(rows, count=40, rounds=5):
    good = [
        (k, v, whole(v))
        for k, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]

    def place(row):
        return (row[0] is None, "" if row[0] is None else hashlib.sha256(f"2:{row[0]}".encode()).hexdigest(), row[1])

    centres = [q for _, _, q in sorted(good, key=place)[:count]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        mine = {}
        for _, _, q in good:
            mine.setdefault(nearest(q)[1], []).append(q)
        centres = [
            [sum(column) // len(mine[j]) for column in zip(*mine[j], strict=True)] if j in mine else c
            for j, c in enumerate(centres)
        ]
    found = [(k, *nearest(q)) for k, _, q in good]
    each = {}
    for _, d, j in found:
        each[j] = each.get(j, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    top = zones.LARGEST
    return sorted(
        ((k, j, min(d, top), min(each[j], top), min(sum(each.values()), top), digests[j]) for k, d, j in found), key=repr
    )


def found(spark, rows):
    frame = spark.createDataFrame([(k, v, "a", "b", "c", "d") for k, v in rows], KIND)
    return sorted((tuple(r) for r in zones.with_inertia(*zones.clustered(frame)).collect()), key=repr)


def gathered(seed, groups, size, spread=0.05):
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = draw.normal(size=64)
        out += (centre + draw.normal(size=(size, 64)) * spread).tolist()
    return list(enumerate(out))


ODD = [
    (900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 63 + [None]), (904, [float("nan")] * 64),
    (905, [float("-inf")] * 64), (None, [0.25] * 64), (None, None), (5, [0.0] * 64), (5, [-0.1] * 64),
]


def test_against_every_distance(spark):
    rows = gathered(3, 12, 60) + [(1000 + k, [0.5] * 64) for k in range(300)] + ODD
    assert found(spark, rows) == by_hand(rows)


def test_fewer_vectors_than_centroids_and_ties(spark):
    rows = [(k, [float(k % 3)] * 64) for k in range(9)] + ODD
    assert found(spark, rows) == by_hand(rows)


def test_components_of_any_size(spark):
    rows = [(k, [x] * 64) for k, x in enumerate([1e-300, 1.0, -3e5, 7e18, 1e38, -1e300, 1.7e308, 9e15])]
    rows += gathered(5, 2, 30)
    kept = zones.whole(np.array([rows[6][1]])).tolist()
    assert kept == [whole(rows[6][1])]
    rows = [r for r in rows if r[0] != 7]
    assert [r for r in found(spark, rows) if r[2] < zones.LARGEST] == [r for r in by_hand(rows) if r[2] < zones.LARGEST]
    assert found(spark, rows) == by_hand(rows)


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == []


def test_neighbours_on_the_curve_are_neighbours():
    for axes, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.indices([1 << bits] * axes).reshape(axes, -1).T
        keys = zones.hilbert_keys(grid, bits)
        order = np.lexsort(keys.T[::-1])
        steps = np.abs(np.diff(grid[order], axis=0)).sum(axis=1)
        assert len(np.unique(keys, axis=0)) == len(grid)
        assert (steps == 1).all()


def test_boxes_rule_out_centroids_that_are_never_nearest():
    draw = np.random.default_rng(9)
    centroids = np.floor(draw.normal(size=(40, 64)) * 256)
    points = np.floor((draw.normal(size=64) + draw.normal(size=(500, 64)) * 0.05) * 256)
    some = zones.candidates(points.min(axis=0), points.max(axis=0), centroids)
    best, _ = zones.nearest(points, centroids)
    assert set(best.tolist()) <= set(some.tolist())
    assert len(some) < 20


def test_query_against_sql(spark, sf_dir):
    rows = sorted(tuple(r) for r in registered.queries()["op13_hilbert_clustering"](spark, sf_dir).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    assert rows == sorted(con.sql(oracles.ORACLES["op13_hilbert_clustering"]).fetchall())
