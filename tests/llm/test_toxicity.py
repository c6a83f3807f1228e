import pyarrow as pa

from tristar.llm.toxicity import (DISCOUNTED, INSULT, NEGATION, OTHER, PLAIN, REPORTED, TARGET,
                                  TARGETED, Grammar, _hash_words, judge, keep_clean, op9)


def test_composed_machine():
    run = Grammar.run
    assert run([OTHER, INSULT], [0, 2.0]) == [(PLAIN, 2.0)]
    assert run([TARGET, OTHER, INSULT], [0, 0, 2.0]) == [(TARGETED, 2.0)]
    assert run([INSULT, OTHER, TARGET], [2.0, 0, 0]) == [(TARGETED, 2.0)]
    assert run([NEGATION, OTHER, INSULT, INSULT], [0, 0, 2.0, 1.0]) == [(DISCOUNTED, 2.0),
                                                                       (DISCOUNTED, 1.0)]
    assert run([NEGATION, OTHER, OTHER, OTHER, INSULT], [0, 0, 0, 0, 1.0]) == [(PLAIN, 1.0)]
    assert run([REPORTED, *[OTHER] * 9, INSULT], [*[0] * 10, 1.0]) == [(DISCOUNTED, 1.0)]


def test_clauses_do_not_leak():
    g = Grammar({int(_hash_words(["fool"])[0]): 3.0})
    f = g.features(pa.array(["he said. Fool!", "he said fool", "nothing", None, "", "FOOL, fool",
                             "you fool " + "x " * 100 + ". " + "y " * 100 + "fool"]))
    assert f[0][PLAIN] > 0 and f[0][DISCOUNTED] == 0
    assert f[1][PLAIN] == 0 and f[1][DISCOUNTED] > 0
    assert (f[2:5] == 0).all()
    assert f[5][PLAIN] > f[0][PLAIN]
    assert f[6][PLAIN] > 0 and f[6][TARGETED] > 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in op9(spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = [(rows[r["doc_id"]], r["toxic"]) for r in
              spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(r, y) for r, y in labels if r["held_out"]]
    assert sum(r["predicted"] for r, y in held if y) >= 0.8 * sum(y for _, y in held)
    assert sum(r["predicted"] for r, y in held if not y) <= 0.01 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r, _ in labels)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (None, "a", 1.0), (2, "a" * 90000, 2.0)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = judge(docs, none).collect()
    assert len(rows) == 4 and all(r["score"] == 0 and r["predicted"] == 0 for r in rows)
    assert keep_clean(docs, none).columns == docs.columns and keep_clean(docs, none).count() == 4
    assert judge(docs.limit(0), none).count() == 0
