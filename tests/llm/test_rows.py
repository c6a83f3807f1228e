import pytest

from tristar.llm import near_dedup, passage_dedup, passage_spans
from tristar.llm.rows import row_number_of, sieve


def test_numbers_are_pinned_for_the_session(spark):
    spark.conf.unset("spark.sql.files.minPartitionNum")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = {(r["n"], r["doc_id"]) for r in docs.select(row_number_of(docs).alias("n"), "doc_id").collect()}
    assert spark.conf.get("spark.sql.files.minPartitionNum") == str(spark.sparkContext.defaultParallelism)
    two = docs.withColumn("n", row_number_of(docs)).collect()
    assert one == {(r["n"], r["doc_id"]) for r in two} and len(one) == docs.count()


def test_sieve_keeps_every_wanted_row_and_few_others(spark):
    ids = [0, 7, 32767, 32768, (5 << 33) + 11, *range(1 << 33, (1 << 33) + 2000)]
    wanted = spark.createDataFrame([(i,) for i in ids], "node long")
    df = spark.range(100_000).selectExpr("id AS row", "'t' AS text").unionByName(
        wanted.selectExpr("node AS row", "'t' AS text"))
    got = sieve(df, "row", wanted)
    assert got.columns == ["row", "text"]
    rows = [r["row"] for r in got.collect()]
    assert set(ids) <= set(rows) and len(rows) < len(ids) + 4 + 100
    assert sieve(df, "row", wanted.limit(0)).count() == 0


def test_texts_that_no_bucket_holds_are_not_shuffled(spark):
    # 2 of 400 texts are alike; before, the join by row shuffled all of them.
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(300))) for i in range(399)]
    docs = spark.createDataFrame([*rows, (399, rows[7][1] + " more")], "doc_id long, text string").coalesce(1)
    path = spark.conf.get("spark.checkpoint.dir") + "/sieve-docs"
    docs.write.mode("overwrite").parquet(path)
    seen = []

    def spy(df, column, wanted):
        out = sieve(df, column, wanted)
        seen.append((df.count(), out.count()))
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(near_dedup, "sieve", spy)
        got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(spark.read.parquet(path)).collect()}
    assert got == {i: 7 if i == 399 else i for i in range(400)}
    assert seen[0][0] == 400 and seen[0][1] <= 4


def test_texts_without_a_shared_passage_are_not_shuffled(spark):
    # Documents 7 and 399 share a line of 60 words; before, both joins shuffled all texts.
    line = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    docs = spark.createDataFrame([(i, f"{line(i)}\n{line(-i - 1)}") for i in range(399)]
                                 + [(399, f"{line(7)}\nend")], "doc_id long, text string").coalesce(1)
    path = spark.conf.get("spark.checkpoint.dir") + "/sieve-passages"
    docs.write.mode("overwrite").parquet(path)
    seen = []

    def spy(df, column, wanted):
        out = sieve(df, column, wanted)
        seen.append((df.count(), out.count()))
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(passage_dedup, "sieve", spy)
        m.setattr(passage_spans, "sieve", spy)
        lines, _ = passage_dedup.passages(spark.read.parquet(path))
        got = {(r["doc_id"], r["line"], r["removed"]) for r in lines.collect()}
    assert got == {(7, 0, False), (399, 0, True)}
    assert [n for n, _ in seen] == [400, 400] and max(k for _, k in seen) <= 4
