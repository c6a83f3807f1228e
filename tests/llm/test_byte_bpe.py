import hashlib
import itertools
from array import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tristar.llm.bpe_words import public_path
from tristar.llm.byte_bpe import FILE, ByteBpe, decode_ids, encode_texts, load, op12, read_ranks

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH, PATTERN = public_path(FILE), public_tokenizers.PATTERN
LIB = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH),
                        special_tokens={})
WEIRD = ["", " ", "a\t \tb", "a \xa0 \xa0 b", "a\t\n\tb", "a\t\nb", "a \tb", "\ta b", "a\t b",
         " a", "a ", "a\n b", "\na\nb\n", "   ", "a\n", "\n\nab  c\t\n d", "it's I'LL we've 's 't", "<|endoftext|>",
         "a" * 20_000, "abcdefgh" * 3_000, " " * 3001, "\x85\xa0 　x\x1c y", "日本語 テスト",
         "\U0001f600\U0001f600", "é" * 700, "1234567 12a3½²", "ↀxⅠ", "͸ a͸",
         "xᲉy \U00011de0 1\U00011de0 Ɤ", "".join(map(chr, range(1, 300)))]


def ids_of(text):
    return list(array("I", load(PATH, PATTERN).encode(text)))


@pytest.mark.parametrize("text", WEIRD)
def test_equals_library(text):
    ids = ids_of(text)
    assert ids == LIB.encode_ordinary(text)
    assert load(PATH, PATTERN).decode(array("I", ids).tobytes()) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60),
                 st.lists(st.sampled_from(["ab", "th", "e", " ", "in", "\n", "1", "é", "日",
                                           "!!", "  ", "xx", "aaaa", "'s", "\x85", "er",
                                           "\t", "\xa0", "\x1c", "the", "one"]),
                          max_size=40).map("".join)))
def test_equals_library_on_any_text(text):
    assert ids_of(text) == LIB.encode_ordinary(text)


def test_backtracking_equals_merging_where_longest_matches_fail():
    ranks = {bytes([b]): b for b in range(256)}
    for k, t in enumerate([b"bc", b"ab", b"cd", b"de", b"bcde", b"ea"]):
        ranks[t] = 256 + k
    bpe = ByteBpe(ranks, r".+")
    failed = 0
    for raw in map(bytes, itertools.product(b"abcde", repeat=5)):
        failed += [i for _, (i, _) in bpe.automaton.iter_long(raw.decode())] != bpe.merge(raw)
        assert bpe.encode_match(raw) == bpe.merge(raw)
    assert failed
    with pytest.raises(ValueError):
        ByteBpe({b"a": 0}, r".+")


def test_work_grows_with_the_bytes():
    import time
    bpe, took = load(PATH, PATTERN), []
    for n in (20_000, 160_000):
        raw = b"zqxj" * (n // 4)
        t0 = time.process_time()
        bpe.encode_match(raw)
        took.append(time.process_time() - t0)
    assert took[1] < 40 * took[0] + 0.2   # 8 times the bytes; the square would be 64 times


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or ""
             for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op12(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIB.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIB.decode_bytes(ids)).hexdigest()


def test_null_empty_repeated_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "a b", "z"), (1, "a b", "z")],
                               "doc_id long, text string, ids string")
    out = encode_texts(df)
    rows = out.collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"])) for r in rows) == [
        (0, b"a b"), (1, b""), (1, b""), (1, b"a b")]
    assert sorted(bytes(r["decoded"]) for r in decode_ids(out).collect()) == [
        b"", b"", b"a b", b"a b"]
    assert encode_texts(df.limit(0)).count() == 0
