from __future__ import annotations

import glob
import zlib

import numpy as np
import pytest

from hourtally.llm import registered, tokens

pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


def whole_ids(text):
    found = tokenizers.Tokenizer.from_file(registered.tokenizer_path()).encode(text or "", add_special_tokens=False)
    return found.ids


def by_hand(rows):
    out, at = [], 0
    for doc_id, text in rows:
        ids = whole_ids(text) + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_given_documents(spark, sf_dir):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = sorted(tuple(r) for r in registered.op4_token_output(spark, sf_dir).collect())
    assert found == by_hand(rows)


@pytest.mark.parametrize("kept", [400_000, 3])
def test_word_by_word_gives_the_ids_of_the_whole(monkeypatch, kept):
    monkeypatch.setattr(tokens, "KEPT_WORDS", kept)
    texts = [
        "It's we'll THE'RE don't", "a b c\x1cd\te\r\nf\x0bg", "<|endoftext|> x<|startoftext|>y", "é ́e 하",
        "ΑΣ ΣΑΣ. ΟΔΟΣ", "İstanbul ﬀ ½ 12345", "  two  blanks\n\n", "", None, "😀 😀👍🏽", "日本語 テスト", "x" * 500, "'s 's's",
        "Übergröße! ÉLÈVE,%%% naïve## don't. a.b re: <| [x] O'REILLY x_y Ðe Þú ÿ. ÷x ×y µm 3rd v2 été--été é́.",
    ]
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    path = registered.tokenizer_path()
    for _ in range(2):
        found = [np.frombuffer(x, "<u4").tolist() for x in tokens.encode(path, texts)]
        assert found == [whole_ids(t) for t in texts]


def test_tokenizer_that_keeps_white_space():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["It is  so, é\n here", "", "word"]
    whole = tokenizers.Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.encode(path, texts)] == [x.ids for x in whole]


def test_layout_and_selective_reading(spark, sf_dir, scratch):
    import pyarrow.parquet as pq

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokens.write_tokens(docs, scratch, registered.tokenizer_path())
    for name in glob.glob(f"{scratch}/*.parquet"):
        held = pq.ParquetFile(name).metadata
        for g in range(held.num_row_groups):
            column = held.row_group(g).column(5)
            assert column.path_in_schema.startswith("tokens") and column.has_offset_index
            assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)
    counts = tokens.read_tokens(spark, scratch).select("doc_id", "n_tokens")
    plan = counts._jdf.queryExecution().toString()
    assert "tokens:array" not in plan.split("ReadSchema")[-1]
    assert counts.count() == docs.count()


def test_odd_rows(spark, odd_docs, no_docs, scratch):
    tokens.write_tokens(odd_docs, f"{scratch}/a", registered.tokenizer_path())
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    found = sorted(tuple(r)[1:] for r in tokens.digests(spark, f"{scratch}/a").collect())
    assert found == [r[1:] for r in by_hand(rows)]
    tokens.write_tokens(no_docs, f"{scratch}/b", registered.tokenizer_path())
    assert tokens.digests(spark, f"{scratch}/b").count() == 0


def test_words_and_runs_of_letters_are_kept_within_one_bound(monkeypatch):
    path = registered.tokenizer_path()
    monkeypatch.setattr(tokens, "KEPT_WORDS", 100)
    kept = tokens._words(path)
    kept.clear()
    kept.pieces.clear()
    text = " ".join(f"{a}{b}xy" for a in "abcdefghi" for b in "klmnopqrst")  # 90 words, 90 runs of letters
    (ids,) = tokens.encode(path, [text])
    assert np.frombuffer(ids, "<u4").tolist() == whole_ids(text)
    assert len(kept) + len(kept.pieces) <= 100


def test_words_are_let_go_when_files_are_read_back():
    tokens.encode(registered.tokenizer_path(), ["some words"])
    assert not list(tokens._checked(iter([])))
    assert tokens._words.cache_info().currsize == 0


def test_a_run_of_letters_is_encoded_once_for_all_texts_of_a_batch(monkeypatch):
    path = registered.tokenizer_path()
    texts = [f"Zyxwa zyxwb, ZYXWC!? {i} zyxwa.\nÉlève zyxwb" for i in range(40)] + [None, ""]
    encoded, piece = [], tokens._Words.piece
    monkeypatch.setattr(tokens._Words, "piece", lambda self, letters: encoded.append(letters) or piece(self, letters))
    monkeypatch.setattr(tokens, "KEPT_WORDS", 2)
    tokens._words.cache_clear()
    tokens._words(path)
    encoded.clear()
    found = [np.frombuffer(x, "<u4").tolist() for x in tokens.encode(path, texts)]
    assert found == [whole_ids(t) for t in texts]
    assert sorted(encoded) == ["zyxwa", "zyxwb", "zyxwc", "élève"]
