from __future__ import annotations

import math

from pyspark.sql import functions as F

from hourtally.llm import language, registered


def phrases(text, known):
    """Phrases of a greedy parse, each the longest that occurs in ``known``, one letter at least."""
    count = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in known:
            end += 1
        count, at = count + 1, end
    return count


def plain(text):
    out = "".join(c if c.isalpha() else " " for c in text.lower())
    return "".join(c for i, c in enumerate(out) if c != " " or (i and out[i - 1] != " "))


def test_parse_is_the_greedy_one():
    known = {"en": ["the other then there", "he ran"], "de": ["der andere dann dort", "er lief"]}
    model = language.learn(known)
    texts = ["The there, other! ran", "der dann xyz lief", "then", "q"]
    bits, _ = language.entropies(model, texts)
    for i, text in enumerate(texts):
        for j, name in enumerate(model.languages):
            whole = " ".join(plain(t) for t in known[name]) + " "
            want = phrases(plain(text), whole) * math.log2(len(whole)) / len(plain(text))
            assert abs(bits[i, j] - want) < 1e-9


def test_held_out_accuracy(spark, sf_dir):
    found = registered.op1_cross_parsing_language(spark, sf_dir)
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(labelled, "doc_id").where("held_out").collect()
    assert len(rows) > 30
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == labelled.count()


def test_held_out_rows_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    other = docs.withColumn("text", F.when(language.held_out(F.col("doc_id")), "zzz").otherwise(F.col("text")))
    assert language.sample(docs) == language.sample(other)


def test_odd_rows(spark, odd_docs, no_docs):
    model = language.fitted(odd_docs)
    found = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language.identify(odd_docs, model).collect()}
    for key in ((2, None), (3, ""), (4, " \t\n "), (6, "123 456 !!"), (None, None)):
        assert found[key] == ("und", 0.0)
    assert found[7, "é"][0] in model.languages
    assert language.identify(odd_docs, model).count() == odd_docs.count()
    nothing = language.fitted(no_docs)
    assert nothing.languages == []
    assert {r.lang_pred for r in language.identify(odd_docs, nothing).collect()} == {"und"}
    assert language.identify(no_docs, model).count() == 0


def test_runs_parsed_side_by_side(monkeypatch):
    model = language.learn({"en": ["the quick brown fox jumps over the lazy dog " * 5], "xx": ["zzz qqq " * 20]})
    texts = ["the quick dog " * n for n in (1, 50, 200)] + ["", None]
    bits, _ = language.entropies(model, texts)
    monkeypatch.setattr(language, "ABREAST", 3)
    again, _ = language.entropies(model, texts)
    assert (bits == again).all()


def test_large_alphabets_cost_little():
    draw = __import__("random").Random(4)
    known = {"zz": ["".join(chr(0x4E00 + draw.randrange(5000)) for _ in range(30_000))]}
    for i in range(19):
        letters = [chr(0x400 + 8 * i + k) for k in range(30)]
        known[f"l{i:02}"] = ["".join(draw.choice([*letters, " "]) for _ in range(30_000))]
    model = language.learn(known)
    assert len(model.alphabet) > 4900
    assert sum(x.nbytes for x in (model.fresh, model.steps, model.after)) < 100_000_000
    texts = [t[0][5000:5200] for t in known.values()]
    assert language.predict(model, texts)[0] == list(known)


def test_letters_of_all_planes_and_late_letters(spark):
    late = "1234567 " * 600 + "ein text der erst spät beginnt und dann lange weiter geht " * 40
    rows = [(i, text, lang) for i, (text, lang) in enumerate([(late, "xx"), ("\U00030000\U00030001 " * 30, "yy"), ("plain words here", "en")] * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fitted(docs)
    assert model.languages == ["en", "xx", "yy"]
    assert all(r.lang == r.lang_pred for r in language.identify(docs, model).collect())


def test_samples_are_spread_over_the_text():
    import numpy as np

    codes = np.arange(1, 100_001, dtype=np.uint32)
    some = language.spread(codes, 3000)
    assert len(some) == 3000 and some[0] == 1 and some.max() > 99_000
    assert np.diff(np.flatnonzero(np.diff(some.astype(np.int64)) > 1)).max() < 600
    assert (language.spread(codes[:50], 3000) == codes[:50]).all()


def test_predictions_of_the_query_by_hand(spark, sf_dir):
    """Every language and score once more, from the same samples, by the greedy parse."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = language.sample(docs)
    wholes = {}
    for name, texts in known.items():
        wholes[name] = "".join(plain(t) + " " for t in texts)[: language.SAMPLE_SYMBOLS]
    found = {r.doc_id: r for r in registered.op1_cross_parsing_language(spark, sf_dir).collect()}
    rows = sorted((len(r.text or ""), r.doc_id, r.text) for r in docs.collect())[:25]
    for _, doc_id, text in rows:
        parsed = plain(text or "")
        if not parsed.strip():
            assert found[doc_id].lang_pred == "und"
            continue
        runs = [parsed[k : k + language.RUN] for k in range(0, len(parsed), language.RUN)]
        bits = {n: sum(phrases(r, w) for r in runs) * math.log2(len(w)) / len(parsed) for n, w in wholes.items()}
        best = min(sorted(bits), key=bits.get)
        assert found[doc_id].lang_pred == best
        score = 1 / sum(2 ** (language.SHARPNESS * (bits[best] - b)) for b in bits.values())
        assert abs(found[doc_id].score - score) < 1e-9


def test_no_language_labelled(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    found = language.identify(docs, language.fitted(docs)).collect()
    assert {(r.doc_id, r.lang_pred, r.lettered) for r in found} == {(1, "und", True), (2, "und", False), (3, "und", False)}
