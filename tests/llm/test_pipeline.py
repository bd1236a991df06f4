from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline
from hourtally.llm import language, mixing, stored

from .test_decontaminate import plain
from .test_minhash import shingles
from .test_tokens import whole_ids

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def near_duplicates(rows):
    """Ids that stay: the smallest of each group, and all without words."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return {d for d in ids if top(d) == d}


def test_stages_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "minhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_output"]

    def apply(name, frame):
        out = stored.written(stages[name](spark, frame, sf_dir), name)
        return out

    after = apply("language_id", docs)
    assert after.columns == DOCUMENT and {r.doc_id for r in after.collect()} == kept
    after = apply("minhash_near_dedup", after)
    kept = near_duplicates([(d, texts[d]) for d in kept])
    assert after.columns == DOCUMENT and {r.doc_id for r in after.collect()} == kept
    after = apply("benchmark_decontamination", after)
    items = [plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {d for d in kept if not any(i and i in plain(texts[d]) for i in items)}
    assert after.columns == DOCUMENT and {r.doc_id for r in after.collect()} == kept
    order = [r.doc_id for r in sorted(mixing.mixed(after).collect(), key=lambda r: r.position)]
    after = apply("source_mixing", after)
    assert after.columns == DOCUMENT and {r.doc_id for r in after.collect()} == kept
    found = sorted(apply("token_output", after).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == order
    at = 0
    for r in found:
        ids = whole_ids(texts[r.doc_id]) + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, odd_docs, tmp_path, empty):
    docs = odd_docs.select(DOCUMENT)
    (docs.where("1 = 0") if empty else docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    lettered = sum(any(c.isalpha() for c in r.text or "") for r in docs.collect())
    assert len(found) == (0 if empty else lettered - 1)


def test_rejected_documents_have_no_letter(odd_docs):
    names = {r.lang_pred for r in language.identify(odd_docs, language.fitted(odd_docs)).where("text IS NULL").collect()}
    assert names == {language.UNDETERMINED}


def test_no_language_labelled_keeps_lettered_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("lang", language.F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, docs, sf_dir)
    lettered = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in kept.collect()} == lettered
