import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tristar.llm.packing import Places, load, op2, pack_documents, patterns, public_path

tokenizers = pytest.importorskip("tokenizers")
PATH = public_path("byte_bpe_50k.json")
LIB = tokenizers.Tokenizer.from_file(PATH)


def lib_ids(text):
    return LIB.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "a  b", "a   b\n\n c\n", "\n\n\nx", "a<|endoftext|>b",
                                  "it's 12 I'LL ½x²  \t\n y", "x" * 3000, "a\t b \tc\td\n\te \n f"])
def test_ids_equal_library(text):
    assert np.frombuffer(load(PATH).encode(text), "<u4").tolist() == lib_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'st 1.\n\t é<|", max_size=30))
def test_ids_equal_library_on_any_text(text):
    assert np.frombuffer(load(PATH).encode(text), "<u4").tolist() == lib_ids(text)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_patterns_use_each_piece_once(hist):
    found = patterns(hist, 64)
    used = Counter()
    for pack, n in found:
        assert 0 < sum(pack) <= 64 and pack == sorted(pack, reverse=True)
        for x in pack:
            used[x] += n
    assert used == Counter(hist) and len(found) <= 128
    places, spans = Places(found), defaultdict(list)
    for k, n in hist.items():
        seq, off = places.find(np.full(n, k), np.arange(n))
        for s, o in zip(seq, off):
            spans[s].append((o, k))
    for s in spans.values():
        at = 0
        for o, k in sorted(s):
            assert o == at
            at += k
        assert at <= 64
    assert len(spans) == sum(n for _, n in found)


def check(rows, texts):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        ids, at = [*lib_ids(text or ""), 0], 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            piece = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece))
            at += r["length"]
        assert at == len(ids)
    padded = total = 0
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        total += at
        padded += 1024
    return padded, total


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    padded, total = check(op2(spark, sf).collect(), texts)
    assert padded - total < 1024 + 0.02 * total


def test_null_empty_repeated_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "a b", 7), (3, "a b", 7),
                                (4, "word " * 5000, 8)], "doc_id long, text string, length int")
    rows = pack_documents(df).collect()
    check(rows, {1: None, 2: "", 4: "word " * 5000})
    assert [r["doc_tokens"] for r in rows if r["doc_id"] == 3] == [3, 3]
    assert pack_documents(df.limit(0)).count() == 0
