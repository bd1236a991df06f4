from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from hourtally.llm import quality, registered, textbytes


def test_held_out_ranking(spark, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    rows = [r for r in registered.op7_random_indexing_quality(spark, larger).collect()]
    assert len(rows) == spark.read.parquet(f"{larger}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    good = np.array([r.score for r in held if labels[r.doc_id] == 1])
    bad = np.array([r.score for r in held if labels[r.doc_id] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.9
    assert (good >= 0.3).mean() > 0.95


def test_word_vectors_are_sums_over_the_corpus(spark):
    texts = ["aa bb cc", "bb aa", None, "", "aa"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    table = quality.word_vectors(frame.repartition(3))
    index = quality.index_vectors().astype(float)

    def bucket(word):

        return int(quality.word_buckets(next(textbytes.blocks(pa.array([word]))))[0][0])

    aa, bb, cc = (bucket(w) for w in ("aa", "bb", "cc"))
    total = 3 * index[aa] + 2 * index[bb] + index[cc]
    want = (total / np.linalg.norm(total) + index[aa] / np.linalg.norm(index[aa])) / 2
    assert np.allclose(table[aa], want, atol=1e-6)
    assert np.allclose(table, quality.word_vectors(frame.coalesce(1)))


def test_probabilities_are_calibrated():
    draw = np.random.default_rng(3)
    values = draw.normal(size=(4000, 2 * quality.DIMENSIONS)).astype(np.float32)
    chance = 1 / (1 + np.exp(-2 * values[:, 0]))
    labels = (draw.random(4000) < chance).astype(int)
    found = quality.score(quality.train(values, labels, 15), values)
    assert abs(found.mean() - labels.mean()) < 0.05
    assert np.corrcoef(found, chance)[0, 1] > 0.8


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (5, 7)], [(1, 1), (5, 0), (3, 1), (3, 1)]])
def test_odd_rows(spark, odd_docs, no_docs, labels):
    table, network = quality.fit(odd_docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    found = quality.scored(odd_docs, table, network).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert quality.scored(no_docs, table, network).count() == 0


def test_empty_tables(spark, no_docs):
    table, network = quality.fit(no_docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert np.isfinite(table).all() and quality.score(network, np.zeros((1, 2 * quality.DIMENSIONS)))[0] == 0.5


def test_scores_of_the_query_by_hand(spark, sf_dir):
    """Every tenth score once more: words by a pattern, means, spreads and both layers number by number."""
    import math
    import re

    from hourtally.llm import registered

    word = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x20\x09-\x0DA-Za-z0-9\x80-\xff]+")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table, network = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = {r.doc_id: r for r in registered.op7_random_indexing_quality(spark, sf_dir).collect()}
    for row in docs.orderBy("doc_id").collect()[::10]:
        vectors = []
        for piece in word.findall((row.text or "").encode()):
            buckets, _ = quality.word_buckets(next(textbytes.blocks(pa.array([piece.decode(errors="surrogatepass")]))))
            vectors.append(table[buckets[0]].tolist())
        columns = list(zip(*vectors, strict=True)) or [[0.0]] * quality.DIMENSIONS
        mean = [sum(c) / len(c) for c in columns]
        spread = [math.sqrt(max(0.0, sum(x * x for x in c) / len(c) - m * m)) for c, m in zip(columns, mean, strict=True)]
        values = [(v - c) / s for v, c, s in zip(mean + spread, network.centre.tolist(), network.scale.tolist(), strict=True)]
        hidden = [
            math.tanh(sum(v * w for v, w in zip(values, network.first[:, k].tolist(), strict=True)) + network.first_bias[k])
            for k in range(quality.HIDDEN)
        ]
        total = sum(h * w for h, w in zip(hidden, network.second.tolist(), strict=True)) + network.second_bias
        score = 1 / (1 + math.exp(-total / network.temperature))
        assert abs(found[row.doc_id].score - score) < 2e-3
        assert found[row.doc_id].predicted == (found[row.doc_id].score >= 0.3)
