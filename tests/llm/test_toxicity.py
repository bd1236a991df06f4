from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourtally.llm import registered, textbytes, toxicity

LETTERS = re.compile(rb"[a-z\x80-\xff]+")
ORDER = toxicity.ORDER


def runs_by_hand(word):
    signs = bytes(ORDER) + word + b"\0"
    return [signs[i - ORDER : i + 1] for i in range(ORDER, len(signs))]


def words_by_hand(text):
    return LETTERS.findall((text or "").lower().encode())


class ByHand:
    """Counts as dictionaries; the formulas once more, run by run."""

    def __init__(self, texts, toxic, ordinary):
        longer = {run for text in texts for word in words_by_hand(text) for run in runs_by_hand(word)}
        self.shared = {}
        for order in range(ORDER, 0, -1):
            counted = Counter(run[-order:] for run in longer)
            self.shared[order] = counted
            longer = set(counted)
        self.classes = [Counter(r[1:] for t in some for w in words_by_hand(t) for r in runs_by_hand(w)) for some in (ordinary, toxic)]

    @staticmethod
    def smoothed(counted, run, below):
        before = {k: n for k, n in counted.items() if k[:-1] == run[:-1]}
        if not before:
            return below
        values = list(counted.values())
        once, twice = values.count(1), values.count(2)
        discount = once / (once + 2 * twice) if once and twice else 0.75
        return (max(counted[run] - discount, 0) + discount * len(before) * below) / sum(before.values())

    def difference(self, word):
        total = 0.0
        for run in runs_by_hand(word):
            first = self.shared[1]
            below = (first[run[-1:]] + 0.5) / (sum(first.values()) + 128)
            for order in range(2, ORDER + 1):
                below = self.smoothed(self.shared[order], run[-order:], below)
            ordinary, toxic = (self.smoothed(c, run[1:], below) for c in self.classes)
            total += math.log(toxic) - math.log(ordinary)
        return total


TEXTS = ["Abc abd, ABCDEFGHIJ é", "abd abd xyz", None, "", "9 !!", "xyz éé abc", "abcdefghij abcdefghik"]


def test_differences_by_hand(spark):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    shared = toxicity.shared_counts(frame)
    toxic, ordinary = ["abd abd xyz", "abcdefghij abcdefghik"], ["Abc abd, ABCDEFGHIJ é", "xyz éé abc"]
    rows = [(i, 1, t.lower()) for i, t in enumerate(toxic)] + [(i, 0, t.lower()) for i, t in enumerate(ordinary)]
    tables = toxicity.class_counts(spark.createDataFrame(rows, "fold int, toxic int, text string"))
    hand = ByHand(TEXTS, toxic, ordinary)
    for text in [*toxic, *ordinary, "unseen abx", "zé"]:
        block = next(textbytes.blocks(pa.array([text.lower()])))
        words = toxicity.words_of(block)
        runs, begin = toxicity.runs_of(words)
        each = np.add.reduceat(toxicity.differences(shared, tables[toxicity.BOTH, 0], tables[toxicity.BOTH, 1], runs), begin)[words.which]
        assert each == pytest.approx([hand.difference(w) for w in words_by_hand(text)], rel=1e-4, abs=1e-5)


def test_features_by_hand():
    draw = np.random.default_rng(1)
    tables = [toxicity.Counts(*(draw.integers(0, 5, toxicity.BUCKETS).astype(np.float32) for _ in range(3)), 0.7) for _ in range(8)]
    texts = ["one two three two", "", "9!", "a b c d e f g h i j k l m n o p q r s", None, "é"]
    block = next(textbytes.blocks(pa.array(texts)))
    found = toxicity.features(tables[:6], *tables[6:], block)
    for text, row in zip(texts, found, strict=True):
        words = words_by_hand(text)
        if not words:
            assert not row.any()
            continue
        each = []
        for word in words:
            alone = toxicity.runs_of(toxicity.words_of(next(textbytes.blocks(pa.array([word.decode()])))))[0]
            each.append((float(toxicity.differences(tables[:6], *tables[6:], alone).sum()), len(word) + 1))
        total, size = sum(d for d, _ in each), sum(n for _, n in each)
        wanted = [total / size, total / math.sqrt(size), math.log1p(size)]
        best = sorted(each, key=lambda x: -x[0])
        for most in toxicity.TELLING:
            told = sum(d for d, _ in best[:most])
            wanted += [told / most, told / sum(n for _, n in best[:most])]
        assert row.tolist() == pytest.approx(wanted, rel=1e-4, abs=1e-4)


def prose(draw, words, bad, size):
    out = [draw.choice(words) for _ in range(size)]
    for _ in range(max(2, size // 40) if bad else 0):
        out[draw.randrange(size)] = draw.choice(bad)
    return " ".join(out)


@pytest.fixture(scope="module")
def planted(spark):
    draw = random.Random(6)
    words = ["".join(draw.choice(["ba", "de", "lo", "mi", "ru", "ten"]) for _ in range(draw.randint(1, 4))) for _ in range(600)]
    bad = ["grawk", "snodge", "blurgh"]
    rows = [(k, prose(draw, words, bad if k % 8 == 0 else None, draw.randint(30, 300)), int(k % 8 == 0)) for k in range(1200)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, m) for k, _, m in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {k: m for k, _, m in rows}


def test_held_out_rows_are_told_apart(planted):
    docs, labels, truth = planted
    # Labels of held-out rows are turned round: they must not be learned from.
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model = toxicity.fit(docs, turned)
    wrong = [r.doc_id for r in toxicity.scored(docs, model).collect() if (r.score >= toxicity.THRESHOLD) != bool(truth[r.doc_id])]
    held = [k for k in wrong if zlib.crc32(str(k).encode()) % 3 == 1]
    assert len(wrong) <= 6
    assert len(held) <= 3


def test_bound_of_labelled_rows(planted):
    docs, labels, _ = planted
    chosen, totals = toxicity.labelled(docs, labels, 20)
    assert {r[0]: r[1] for r in chosen.groupBy("toxic").count().collect()} == {0: 20, 1: 20}
    assert totals[0] > 400


def test_odd_rows_and_no_rows(spark, planted, odd_docs, no_docs):
    docs, labels, _ = planted
    model = toxicity.fit(docs, labels)
    found = toxicity.scored(odd_docs, model).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in found)
    blank = {round(r.score, 12) for r in found if r.doc_id in (2, 3, 6)}
    assert len(blank) == 1
    assert toxicity.scored(no_docs, model).count() == 0


@pytest.mark.parametrize("marks", [[], [(1, 1)], [(1, 1), (2, 1), (3, 1)], [(1, None), (None, 1), (4, 7)]])
def test_labels_of_one_kind_or_none(spark, odd_docs, marks):
    labels = spark.createDataFrame([(k, 0, v) for k, v in marks], "doc_id long, quality int, toxic int")
    found = {r.score for r in toxicity.scored(odd_docs, toxicity.fit(odd_docs, labels)).collect()}
    learned = sum(1 for k, v in marks if k is not None and v in (0, 1) and zlib.crc32(str(k).encode()) % 3 != 1)
    assert len(found) == 1
    assert found.pop() == pytest.approx((learned + 1) / (learned + 2))


def test_nothing_to_learn_from(spark, no_docs, odd_docs):
    labels = spark.createDataFrame([(1, 0, 1), (3, 0, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(no_docs, labels).weights[:-1].any() == 0
    assert toxicity.scored(odd_docs, toxicity.fit(odd_docs, labels)).count() == odd_docs.count()


def test_query(spark, sf_dir):
    rows = registered.queries()["op12_kneser_ney_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
