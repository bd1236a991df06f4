from __future__ import annotations

import random

import pytest

from hourtally.llm import decontaminate, registered


def plain(text):
    words, at = [], ""
    for c in (text or "").lower():
        at = at + c if c.isalnum() else (words.append(at) or "" if at else "")
    return " ".join(words + [at] if at else words)


def least_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def by_hand(docs, items):
    out = []
    for doc_id, text in docs:
        for item_id, item in items:
            wanted = plain(item)
            if wanted:
                errors = least_distance(wanted, plain(text))
                if errors <= int(len(wanted) * decontaminate.ERROR_SHARE):
                    out.append((doc_id, item_id, errors))
    return sorted(out)


def planted():
    draw = random.Random(9)

    def prose(n):
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randrange(1, 7))) for _ in range(n))

    items = [(i, prose(18)) for i in range(6)] + [(6, "ab, CD"), (7, None), (8, "!!"), (9, "ö" * 30), (0, prose(12))]
    docs = [(i, prose(30)) for i in range(10)]
    for i, (_, item) in enumerate(items):
        if item:
            for k in range(4):
                spoiled = list(item)
                for _ in range(round(len(item) * 0.05 * k)):
                    at = draw.randrange(len(spoiled))
                    spoiled[at : at + 1] = draw.choice([[], ["x"], [spoiled[at], "y"]])
                docs.append((100 + 10 * i + k, prose(5) + ".\n" + "".join(spoiled).upper() + "!! " + prose(5)))
    return docs + [(None, items[0][1]), (50, None), (51, "")], items


@pytest.mark.parametrize("size", [4_000_000, 250])
def test_planted_items(spark, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "TEXT_BLOCK", 500)
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", size)
    docs, items = planted()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontaminate.item_blocks(benchmark)) == (1 if size > 1000 else 3)
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    found = sorted(((r.doc_id, r.item_id, r.distance) for r in decontaminate.leaks(frame, benchmark).collect()), key=key)
    want = sorted(set(by_hand([d for d in docs if d[0] is not None], items)))
    assert [r for r in found if r[0] is not None] == want
    assert (None, 0, 0) in found
    clean = {r.doc_id for r in decontaminate.without_leaks(frame, benchmark).collect()}
    assert clean == {d for d, _ in docs if d is not None} - {r[0] for r in found}


def test_place_of_a_match():
    items = decontaminate.prepare([(1, "the hidden question, please")])
    text = "Before it. The  HIDDEN question -- please! After."
    (match,) = decontaminate.find(items, ["", text])
    assert (match.text, match.distance) == (1, 0)
    assert text[match.start : match.end] == "The  HIDDEN question -- please"


def test_given_documents(spark, sf_dir):
    rows = {(r.doc_id, r.item_id) for r in registered.op6_pigeonhole_decontamination(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if plain(i.text) in plain(d.text)}
    assert exact and exact <= rows


def test_odd_rows(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(1, "two three four"), (None, "word1 word4 word9"), (3, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd_docs, benchmark).collect()}
    assert found == {(1, 1), (5, -1)}
    assert decontaminate.leaks(odd_docs, benchmark).count() == 3
    clean = decontaminate.without_leaks(odd_docs, benchmark)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count() - 3
    assert decontaminate.leaks(no_docs, benchmark).count() == 0
    nothing = benchmark.where("1 = 0")
    assert decontaminate.leaks(odd_docs, nothing).count() == 0
    assert decontaminate.without_leaks(odd_docs, nothing).count() == odd_docs.count()
