from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

from hourtally.llm import merkle, oracles, registered

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    if value is None:
        return "-"
    return f"{len(str(value).encode())}:{value}"


def tree(low):
    levels = [low]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H("".join(low[k : k + 2])) for k in range(0, len(low), 2)])
    return levels


def siblings(levels, k):
    out = []
    for low in levels[:-1]:
        out.append((k % 2, low[k ^ 1] if k ^ 1 < len(low) else ""))
        k //= 2
    return out


def by_hand(rows):
    """Rows are (doc_id, text, lang, source, n_chars)."""
    by_lang, out = {}, []
    for doc_id, text, lang, source, n_chars in rows:
        leaf = H("".join(field(v) for v in (doc_id, source, lang, n_chars, text)))
        now = leaf
        if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            now = H("".join(field(v) for v in (doc_id, source, lang, n_chars + 1, text)))
        key = (doc_id is not None, doc_id or 0, leaf)
        by_lang.setdefault(lang, []).append((key, doc_id, leaf, now))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([r[2] for r in sorted(by_lang[lang])]) for lang in langs}
    upper = tree([trees[lang][-1][0] for lang in langs]) if langs else []
    for place, lang in enumerate(langs):
        for k, (_, doc_id, leaf, now) in enumerate(sorted(by_lang[lang])):
            steps = siblings(trees[lang], k) + siblings(upper, place)
            folded = now
            for right, other in steps:
                folded = H(other + folded if right else folded + other)
            root = upper[-1][0]
            out.append((doc_id, leaf, trees[lang][-1][0], root, H("".join(o for _, o in steps)), folded, folded == root))
    return sorted(out, key=repr)


def found(frame, **given):
    return sorted((tuple(r) for r in merkle.manifest(frame, **given).collect()), key=repr)


@pytest.mark.parametrize("most", [merkle.LEVELS, 1, 2])
def test_trees_of_several_strides(spark, most):
    sizes = {None: 1, "de": 2, "en": 37, "fr": 5, "é": 16, "zz": 17}
    rows = [(k * 10 + n, f"text {k} {n}", lang, "s", n) for n, (lang, size) in enumerate(sizes.items()) for k in range(size)]
    assert found(spark.createDataFrame(rows, DOCS), most=most) == by_hand(rows)


def test_odd_rows(odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert found(odd_docs) == by_hand(rows)


def test_no_rows(no_docs):
    assert found(no_docs) == []


def test_one_row(spark):
    rows = [(7, "alone", "en", None, None)]
    assert found(spark.createDataFrame(rows, DOCS)) == by_hand(rows)


def test_counts_of_all_sizes_are_tampered_with(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0]
    rows = [(i, "t", "en", "s", n) for i, n in zip(ids, [None, -1, 2**63 - 1, 0, 9], strict=False)]
    assert found(spark.createDataFrame(rows, DOCS)) == by_hand(rows)


def test_query_against_brute_force_and_sql(spark, sf_dir):
    result = registered.queries()["op11_merkle_manifest"](spark, sf_dir)
    rows = sorted((tuple(r) for r in result.collect()), key=repr)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    docs = con.sql("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()
    assert rows == by_hand(docs)
    assert rows == sorted(con.sql(oracles.ORACLES["op11_merkle_manifest"]).fetchall(), key=repr)
    assert not all(r[-1] for r in rows)
