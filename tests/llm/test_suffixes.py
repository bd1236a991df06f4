from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hourtally.llm import registered, suffixes


def by_hand(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def planted():
    draw = random.Random(5)

    def prose(n):
        return "".join(draw.choice("abcdefgh ijé") for _ in range(n))

    common = prose(400)
    rows = [prose(900) for _ in range(20)]
    rows += [prose(draw.randrange(300)) + common + prose(draw.randrange(300)) for _ in range(25)]
    rows += ["z" * 650, "ab" * 300, rows[0], rows[1][:450] + "!" + rows[1][451:], rows[2] + rows[2], None, "", "short"]
    rows += [rows[3][:199], rows[4][:200], rows[5][100:299] + "#"]
    return rows


@pytest.mark.parametrize("together", [2000, 3])
def test_planted_repeats(spark, monkeypatch, together):
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    texts = planted()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    import pyspark.sql.functions as F

    found = suffixes.without_repeats(frame).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")), F.size("spans"), F.sha2("kept", 256)
    )
    assert [tuple(r)[1:] for r in sorted(found.collect())] == by_hand(texts)


def test_given_documents(spark, sf_dir):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = sorted(tuple(r) for r in registered.op3_suffix_array_dedup(spark, sf_dir).collect())
    assert [r[1:] for r in found] == by_hand([t for _, t in rows])


@pytest.mark.parametrize("text", [b"a", b"aaaa", b"banana", b"abracadabra" * 3, bytes(range(256)), b"zyx\x00\xff\xff\x00"])
def test_suffix_array(text):
    assert suffixes.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_long_texts_go_piece_by_piece(monkeypatch):
    from hourtally.llm import textbytes

    draw = np.random.default_rng(2)
    data = draw.integers(97, 105, 5000).astype(np.uint8)
    block = textbytes.Block(0, data, np.array([0]), np.array([5000]))
    whole = [np.concatenate(x) for x in zip(*suffixes._pieces(block), strict=True)]
    monkeypatch.setattr(suffixes, "PIECE", 700)
    pieces = [np.concatenate(x) for x in zip(*suffixes._pieces(block), strict=True)]
    windows = lambda found: {(w, s) for a, b, s in zip(found[1], found[2], found[3], strict=True) for w in range(a, b + 1)}
    assert windows(whole) == windows(pieces)
    assert len(windows(whole)) == 4801


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    found = suffixes.without_repeats(odd_docs)
    assert found.count() == len(rows)
    assert {r.n_bytes for r in found.collect()} == {len((r.text or "").encode()) for r in rows}
    assert suffixes.without_repeats(no_docs).count() == 0
