import random
import re
from collections import defaultdict

from tristar.llm import passage_dedup
from tristar.llm.passage_spans import without
from tristar.llm.registry import QUERIES

SIZE = 50


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return [re.sub(r"[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]


def expected(texts, cut):
    """Plain search: (row, word) of all words in later occurrences of a window, without the words
    that an overlapping first occurrence covers. ``texts``: row -> (doc_id, text)."""
    where = defaultdict(list)
    for row, (doc, text) in texts.items():
        line = [k for k, x in enumerate((text or "").split("\n")) for _ in words(x)]
        w = low(text)
        for p in range(len(w) - SIZE + 1):
            if not any((row, k) in cut for k in set(line[p:p + SIZE])):
                where[tuple(w[p:p + SIZE])].append((doc is None, doc or 0, row, p))
    gone = set()
    for places in where.values():
        places.sort()
        first = places[0]
        for _, _, row, p in places[1:]:
            a = max(p, first[3] + SIZE) if row == first[2] else p
            gone.update((row, k) for k in range(a, p + SIZE))
    return gone


def check(docs):
    numbered = {r["row"]: (r["doc_id"], r["text"]) for r in passage_dedup.numbered(docs).collect()}
    lines, spans = passage_dedup.passages(docs)
    cut = {(r["row"], r["line"]) for r in lines.filter("removed").collect()}
    rows = spans.collect()
    got = {(r["row"], k) for r in rows if r["removed"] for k in range(r["start_word"], r["end_word"])}
    want = expected(numbered, cut)
    assert got == want
    for r in rows:
        line = [k for k, x in enumerate(numbered[r["row"]][1].split("\n")) for _ in words(x)]
        assert line[r["start_word"]] == r["line"] and r["class_size"] > 1
    return want, rows


def test_whole_table_equals_brute_force(spark):
    want, _ = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert want


def test_across_lines_and_inside_lines(spark):
    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    p, q, r = new(60), new(55), new(49)
    lines = lambda w, n: "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))
    rows = [(1, "Head one\n" + lines(p, 9) + "\nend one"),
            (2, "other\n" + lines(p, 13) + "\ntail"),                  # short lines, cut elsewhere
            (3, " ".join(new(300) + q + new(300))),
            (4, " ".join(new(200) + [w.upper() for w in q] + new(200))),  # inside a longer line
            (5, " ".join(r) + " x"), (6, " ".join(r) + " y"),             # one word too few
            (7, "a " * 3000), (8, None), (9, ""), (None, lines(p, 7)), (10, lines(p, 60))]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows],
                               "doc_id long, text string, row string, n_chars int").coalesce(1)
    want, found = check(df)
    assert sum(r["doc_id"] == 2 and r["removed"] for r in found) == 1
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in passage_dedup.cut_repeated(df).collect()}
    assert out[2] == ("other\ntail", 10) and out[None] == ("", 0) and out[10] == ("", 0)
    assert out[1] == (rows[0][1], 0) and out[3] == (rows[2][1], 0) and out[8] == (None, 0)
    assert words(out[4][0]) == words(rows[3][1])[:200] + words(rows[3][1])[255:]
    assert words(out[7][0]) == ["a"] * 50
    assert passage_dedup.repeated_passages(df.limit(0)).count() == 0


def test_cut_of_words():
    assert without("a b c\nd e\n\nf g", [], [(1, 4)]) == "a\ne\n\nf g"
    assert without("a b c d", [], [(1, 3)]) == "a d"
    assert without("x\ny z\nw", [0], [(1, 3)]) == "w"
    assert without(" é b\r\nc", [], []) == " é b\r\nc"


def test_the_query_has_both(spark):
    rows = QUERIES["op1_passage_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert {r["start_word"] is None for r in rows} == {True, False}
