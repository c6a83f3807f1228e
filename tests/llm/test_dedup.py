import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tristar.llm import linking, near_dedup, passage_dedup
from tristar.llm.linking import components, link, tune_bands

SF = "/root/testdata/sf0.001"


def bag(text):
    w = [re.sub(r"[A-Z]", lambda m: m[0].lower(), x)
         for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def classes_of(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def similar_pairs(bags, weight, threshold=0.8):
    where = defaultdict(list)
    for i, b in bags.items():
        for s in b:
            where[s].append(i)
    pairs = {(x, y) for ids in where.values() if len(ids) < 40 for x in ids for y in ids if x < y}
    for x, y in pairs:
        a, b = bags[x], bags[y]
        low = sum(min(a[s], b[s]) * weight(s) for s in a.keys() & b.keys())
        high = sum(a[s] * weight(s) for s in a) + sum(b[s] * weight(s) for s in b) - low
        if low / high >= threshold:
            yield x, y


def noisy(rng, words, share):
    return [rng.choice("abcdefgh") * 3 + str(rng.randrange(999)) if rng.random() < share else w
            for w in words]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows],
                                 "doc_id long, text string, row string, n_chars int").coalesce(1)


def test_tuned_bands():
    b = tune_bands(0.8, 0.997, 4)
    assert 1 - (1 - 0.8 ** 4) ** b >= 0.997 > 1 - (1 - 0.8 ** 4) ** (b - 1)


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(1000, 1030)] + [(2000, i) for i in range(2001, 2100)]
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    want = classes_of(edges, {x for e in edges for x in e if e[0] != e[1]})
    assert got == {n: want[n] for n in want}
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


@pytest.mark.parametrize("small", [64, 2])
def test_links_connect_all_similar_members_of_a_bucket(spark, monkeypatch, small):
    # Sets on a line: neighbours are similar, ends are not, and the leader is an outsider.
    monkeypatch.setattr(linking, "SMALL", small)   # 2: by the prefix join, in tiny blocks
    monkeypatch.setattr(linking, "BLOCK", 3)
    rng = random.Random(5)
    sets = {0: set(range(100, 200))}
    for i in range(1, 32):
        start = rng.randrange(160)
        sets[i] = set(range(start, start + 100))
    sim = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    seen = []

    def compare(pairs):
        rows = [(r["a"], r["b"]) for r in pairs.collect()]
        seen.extend(rows)
        return spark.createDataFrame([(a, b, sim(a, b)) for a, b in rows], "a long, b long, sim double")

    def prefixes(nodes):
        return spark.createDataFrame(
            [(r["node"], key, float(100 - k), 100.0) for r in nodes.collect()
             for k, key in enumerate(sorted(sets[r["node"]])) if 100 - k >= 80],
            "node long, key long, rest double, total double")

    members = spark.createDataFrame([(b, i) for i in sets for b in ((1, 2) if i % 2 else (1,))],
                                    "bucket long, node long")
    links = [(r["a"], r["b"]) for r in link(members, compare, 0.8, "test", prefixes).collect()]
    want = [(a, b) for a in sets for b in sets if a < b and sim(a, b) >= 0.8]
    assert classes_of(links, sets) == classes_of(want, sets)
    assert len(seen) == len(set(seen)) and set(links) <= set(want)


@pytest.mark.parametrize("weighted", [False, True])
def test_prefix_join_of_many_texts_that_share_a_passage(spark, weighted):
    # 2,000 texts about 0.6 alike, with pairs near the threshold on both sides among them.
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(45)]
    words = {i: passage + [word() for _ in range(15)] for i in range(1000)}
    for i in range(1000):
        base = list(words[i])
        for _ in range(rng.randrange(4)):
            base[rng.randrange(45, 60)] = word()
        words[1000 + i] = base
    texts = {i: " ".join(w) for i, w in words.items()}
    df = spark.createDataFrame(list(texts.items()), "node long, text string").repartition(4)
    idf = near_dedup.inverse_frequencies(df) if weighted else np.ones(1 << near_dedup.BUCKET_BITS)
    weigh = lambda h, n: n * idf[near_dedup._bucket(h)] if weighted else np.ones(len(h))
    keys = near_dedup.prefixer(df, weigh, 0.8, "test")(df.select("node"))
    got = {(r["a"], r["b"]) for r in linking.across_keys(
        keys.withColumn("anchor", keys["node"]), 0.8, "test").collect()}
    sims = near_dedup.weighted_jaccard if weighted else (lambda a, b, _: passage_dedup.jaccard(a, b))
    near = [(i, 1000 + i) for i in range(1000)]
    s = sims(pa.array([texts[a] for a, _ in near]), pa.array([texts[b] for _, b in near]), idf)
    want = {p for p, x in zip(near, s) if x >= 0.8}
    assert 100 < len(want) < 1000 and want <= got
    assert len(got) < 20 * len(near)     # of two million pairs

    far = rng.sample([(a, b) for a in range(300) for b in range(a)], 2000)
    assert max(sims(pa.array([texts[a] for a, _ in far]), pa.array([texts[b] for _, b in far]), idf)) < 0.8


def test_one_anchor_meets_nothing(spark):
    keys = spark.createDataFrame([(n, k, 10.0, 10.0, 7 if n < 90 else n) for n in range(93) for k in (1, 2)],
                                 "node long, key long, rest double, total double, anchor long")
    got = {(r["a"], r["b"]) for r in linking.across_keys(keys, 0.8, "test").collect()}
    assert got == {(a, b) for b in (90, 91, 92) for a in range(b)}
    assert linking.across_keys(keys.filter("node < 90"), 0.8, "test").count() == 0


def test_helper_columns_do_not_clash(spark):
    p = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, p, "a", "b", "c", "d"), (2, p, "e", "f", "g", "h")],
                               "doc_id long, text string, near_row string, cut_row string, "
                               "_cut_row string, CUT_LINES string").coalesce(1)
    assert [tuple(r) for r in near_dedup.keep_one(df).collect()] == [(1, p, "a", "b", "c", "d")]
    cut = passage_dedup.cut_repeated(df)
    assert cut.columns == df.columns
    assert sorted(tuple(r) for r in cut.collect()) == [(1, p, "a", "b", "c", "d"),
                                                       (2, "", "e", "f", "g", "h")]


def test_weighted_jaccard_is_exact():
    idf = np.linspace(1, 8, 1 << near_dedup.BUCKET_BITS).astype(np.float32)
    texts = ["a b c d e f g a b c d e", "A b c d e f h", "", "x", None, "a b c d e"]
    left = pa.array([x for x in texts for _ in texts], pa.string())
    right = pa.array([y for _ in texts for y in texts], pa.string())
    got = near_dedup.weighted_jaccard(left, right, idf)

    def weight(s):
        h, _, _ = near_dedup.shingle_sets(*near_dedup.tg.buffers(pa.array([" ".join(s)])))
        return float(idf[near_dedup._bucket(h)[0]])

    for (x, y), s in zip([(x, y) for x in texts for y in texts], got):
        a, b = bag(x), bag(y)
        low = sum(min(a[k], b[k]) * weight(k) for k in a.keys() & b.keys())
        high = sum(a[k] * weight(k) for k in a) + sum(b[k] * weight(k) for k in b) - low
        assert s == pytest.approx(low / high if high else 0, abs=1e-6)


def test_near_duplicates_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = near_dedup.op7(spark, SF).collect()
    assert len(rows) == len(texts)
    got = {r["doc_id"]: r["class_id"] for r in rows}
    idf = near_dedup.inverse_frequencies(docs)

    def weight(s):
        h, _, _ = near_dedup.shingle_sets(*near_dedup.tg.buffers(pa.array([" ".join(s)])))
        return float(idf[near_dedup._bucket(h)[0]])

    cache = {}
    links = list(similar_pairs({i: bag(t) for i, t in texts.items()},
                               lambda s: cache.setdefault(s, weight(s))))
    want = classes_of(links, texts)
    same = sum(got[a] == got[b] for a, b in links)
    assert links and same >= 0.99 * len(links)
    sizes = Counter(got.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in rows)
    joined = [i for i in got if got[i] != i]
    assert sum(want[i] == got[i] for i in joined) >= 0.97 * len(joined)


def test_near_duplicates_edge_cases(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = [(10, " ".join(base)), (3, " ".join(base).upper()), (4, " ".join(noisy(rng, base, 0.01))),
            (5, None), (6, ""), (7, " \n "), (8, "short text"), (9, "short text"), (None, "short text"),
            (9, "short text"), (11, "a " * 30000), (12, " ".join(f"q{i}" for i in range(200)))]
    df = table(spark, rows)
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["class_id"], r["class_size"]))
    assert by[10] == by[3] == by[4] == {(3, 3)}
    assert by[8] == by[9] == by[None] == {(8, 4)}
    assert by[5] == {(5, 1)} and by[6] == {(6, 1)} and by[7] == {(7, 1)} and by[12] == {(12, 1)}
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([10, 5, 6, 7, 8, 11, 12])
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def long_lines(text):
    return [(k, x) for k, x in enumerate((text or "").split("\n"))
            if len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= 50]


def test_repeated_passages_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    lines = {(i, k): x for i, t in texts.items() for k, x in long_lines(t)}
    links = list(similar_pairs({p: bag(x) for p, x in lines.items()}, lambda s: 1))
    links = [(a, b) for a, b in links
             if len(bag(lines[a]).keys() & bag(lines[b]).keys())
             >= 0.8 * len(bag(lines[a]).keys() | bag(lines[b]).keys())]
    want = classes_of(links, lines)
    rows = passage_dedup.op1(spark, SF).collect()
    got = {(r["doc_id"], r["line"]): r["class_id"] for r in rows}
    in_class = Counter(want.values())
    members = {p for p in lines if in_class[want[p]] > 1}
    assert len(members & set(got)) >= 0.99 * len(members) and len(set(got) - members) <= 0.01 * len(got)
    assert sum(got.get(a, 0) == got.get(b, 1) for a, b in links) >= 0.99 * len(links)
    for c in set(got.values()):
        first = [r for r in rows if r["class_id"] == c and not r["removed"]]
        assert len(first) == 1 and first[0]["doc_id"] == first[0]["first_doc_id"] == min(
            r["doc_id"] for r in rows if r["class_id"] == c)


def test_passage_edge_cases(spark):
    rng = random.Random(7)
    p = " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    q = " ".join(noisy(rng, p.split(), 0.02))
    other = " ".join(f"z{i}" for i in range(80))
    rows = [(2, f"a b\n{p}\nc"), (1, f"{other}\n{q}\r\nend"), (3, None), (4, ""), (5, p + "\n" + p),
            (None, p), (6, "short line\nshort line"), (7, " ".join(f"y{i}" for i in range(40_000)))]
    df = table(spark, rows)
    got = passage_dedup.repeated(df).collect()
    assert sorted((r["doc_id"] or 99, r["line"], r["removed"]) for r in got) == [
        (1, 1, False), (2, 1, True), (5, 0, True), (5, 1, True), (99, 0, True)]
    assert len({r["class_id"] for r in got}) == 1
    cut = passage_dedup.cut_repeated(df)
    assert cut.columns == df.columns
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    assert out[2] == ("a b\nc", 5) and out[5] == ("", 0) and out[None] == ("", 0)
    assert out[1] == (rows[1][1], 0) and out[3] == (None, 0) and out[4] == ("", 0)
    assert passage_dedup.repeated(df.limit(0)).count() == 0
    assert passage_dedup.cut_repeated(df.limit(0)).count() == 0
