import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tristar.llm import token_alignment
from tristar.llm.bpe_words import public_path
from tristar.llm.token_alignment import (A_FILE, B_FILE, SHIFT, align, align_documents, link_counts,
                                         load, op11)
from tristar.session import write_stage

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
SF = "/root/testdata/sf0.001"
COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def groups_of(a, b, a_size, b_size):
    """Groups ([A ids], [B ids]) by sets of offsets."""
    ends = [np.cumsum([s[i] for i in x]).tolist() for x, s in ((a, a_size), (b, b_size))]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out, at = [], 0
    for cut in cuts:
        out.append(tuple([i for i, e in zip(x, end) if at < e <= cut] for x, end in zip((a, b), ends)))
        at = cut
    return out


def brute(texts):
    """The contract by the two libraries alone, for [(key, text)]."""
    lib_a = tokenizers.Tokenizer.from_file(public_path(A_FILE))
    lib_a.encode_special_tokens = True
    lib_b = sentencepiece.SentencePieceProcessor(model_file=public_path(B_FILE))
    toks = load(public_path(A_FILE), public_path(B_FILE))
    found, held = {}, Counter()
    for key, text in texts:
        groups, a, b = [], [], []
        if text:
            a = lib_a.encode(" " + text, add_special_tokens=False).ids
            b = lib_b.encode(text)
            raw = (" " + text).encode()
            if any(b"".join(size[i] for i in x) != raw
                   for x, size in ((a, toks.a_bytes), (b, toks.b_bytes))):
                a, b = [], []
            groups = groups_of(a, b, toks.a_size, toks.b_size)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        held.update(links.keys())
        found[key] = (len(a), len(b), groups, links)
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = {}
    for key, (a, b, groups, links) in found.items():
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[key] = (a, b, len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if held[p] == top[p[0]]),
                    sum(n * held[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else "")
    return out


@pytest.mark.parametrize("steps,links", [(512, 1 << 21), (3, 4), (1, 1)])
def test_lockstep_equals_offsets(monkeypatch, steps, links):
    monkeypatch.setattr(token_alignment, "STEPS", steps)
    monkeypatch.setattr(token_alignment, "LINKS", links)
    rng = np.random.default_rng(steps)
    a_size, b_size = np.array([1, 2, 3, 5]), np.array([1, 2, 4, 7, 3])

    def cut(total, size):
        out = []
        while total:
            out.append(int(rng.choice(np.flatnonzero(size <= total))))
            total -= size[out[-1]]
        return np.array(out, np.int32)

    for _ in range(30):
        totals = rng.choice([0, 0, 1, 4, 30, 200], rng.integers(1, 9))
        a, b = [cut(t, a_size) for t in totals], [cut(t, b_size) for t in totals]
        groups, n_links, cuts, first, pairs, times = align(a, b, a_size, b_size)
        for d in range(len(totals)):
            want = groups_of(a[d], b[d], a_size, b_size)
            links_of = Counter((int(x) << SHIFT | int(y)) for ga, gb in want for x in ga for y in gb)
            at = slice(first[d], first[d + 1])
            assert dict(zip(pairs[at].tolist(), times[at].tolist())) == links_of
            assert (groups[d], n_links[d]) == (len(want), sum(links_of.values()))
            assert (cuts[0] == d).sum() == len(want)


TEXTS = [None, "", " ", "a", "  two  spaces ", "tab\t \tb \xa0 \xa0 c", "line\nbreak\n\nagain", "naïve café ﬁ",
         "▁piece", "<s> </s> <unk> <0x0A> <|endoftext|>", "日本語のテスト 한국어", "\U0001f600 ok", "a" * 3000,
         "abcdefgh" * 300, "\x85odd\x1c", "the cat sat. The cat sat.", "the cat sat. The cat sat.",
         "word " * 500, "x \n y", "﻿bom", "1234567 12.5%", "é" * 400, "trailing\n"]


@pytest.mark.parametrize("hot", [200_000, 40, 0])
def test_equals_brute_force(spark, hot):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in rows],
                               "doc_id long, text string, row int, pairs string").repartition(3)
    out = link_counts(write_stage(align_documents(df), "aligned"), hot).collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLS[:-1])
           + (hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_groups"] else r["groups"],)
           for r in out}
    assert got == brute(rows) and len(out) == len(rows)


def test_units_that_are_not_remembered(monkeypatch):
    toks = load(public_path(A_FILE), public_path(B_FILE))
    texts = [t or "" for t in TEXTS]
    first = toks.encode(texts)
    for name, value in (("LONG", 2), ("KNOWN", 0)):
        monkeypatch.setattr(token_alignment, name, value)
        for x, y in zip(first, toks.encode(texts)):
            assert [i.tolist() for i in x] == [i.tolist() for i in y]


def test_query_on_whole_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op11(spark, SF).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLS) for r in rows} == brute(texts)
    assert len(rows) == len(texts)


def test_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a c")], "doc_id long, text string")
    out = link_counts(write_stage(align_documents(df), "aligned"))
    want = brute(enumerate(["a b", "a b", "a c"]))
    assert sorted((r["count_sum"], r["n_best"]) for r in out.collect()) == sorted(
        (w[5], w[4]) for w in want.values())
    assert link_counts(write_stage(align_documents(df.limit(0)), "aligned")).count() == 0
