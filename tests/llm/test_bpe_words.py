import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tristar.llm.bpe_words import encode_texts, load, op5, public_path

tokenizers = pytest.importorskip("tokenizers")
PATH = public_path("word_bpe_49k.json")
LIB = tokenizers.Tokenizer.from_file(PATH)
WEIRD = ["", " ", "Hello\x85world a\xa0b a\x1cb  ΑΣ Σ İx naïve é é ok's I'LL don't 12 3½ x²",
         "a<|endoftext|>b <|STARTOFTEXT|>  q 　z ᠎​ ﻿m", "<|startoftext|><|endoftext|>",
         "word" * 400, "x" * 5000, "日本語 テスト 한국어", "\U0001f600\U0001f600 a\n\n\tb",
         ":\U0003d000 \ua7cbx ab\u1c89c", "\u0390\u0344\u212b \ufb01 \uac00\u11a8"]


def both(text):
    e = LIB.encode(text, add_special_tokens=False)
    return e.ids, LIB.decode(e.ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", WEIRD)
def test_equals_library(text):
    ids, decoded = load(PATH).encode(text)
    assert (np.frombuffer(ids, "<u4").tolist(), decoded) == both(text)
    assert load(PATH).decode(ids) == decoded


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_equals_library_on_any_text(text):
    ids, decoded = load(PATH).encode(text)
    assert (np.frombuffer(ids, "<u4").tolist(), decoded) == both(text)


def test_heap_equals_scan():
    bpe = load(PATH)
    rng = np.random.default_rng(1)
    for _ in range(100):
        word = [bpe.inner[b] for b in rng.choice(list(b"theandinger"), 60)]
        assert bpe._heap(list(word)) == bpe._scan(list(word))


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, decoded = both(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_null_empty_repeated_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "a b", "z"), (1, "a b", "z")],
                               "doc_id long, text string, ids string")
    rows = encode_texts(df).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in rows) == [
        (0, "a</w> b</w>"), (1, ""), (1, ""), (1, "a</w> b</w>")]
    assert encode_texts(df.limit(0)).count() == 0
