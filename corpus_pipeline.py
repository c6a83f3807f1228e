"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of
``documents``; their decisions take effect for everything after them:

1. quality rules drop documents that fail the base rule or the trained verdict;
2. toxicity drops documents that the pattern grammar scores at 0.5 or more;
3. MinHash near-dedup keeps one document of each class;
4. substring dedup removes repeated paragraphs from the texts (and counts n_chars anew);
5. packing cuts what is left into sequences of 1,024 tokens.

An empty table passes through every stage as an empty table. See each operator for what it
does with nulls, empty and very long texts, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tristar.llm import near_dedup, packing, passage_dedup, quality_rules, toxicity
from tristar.session import write_stage

ORACLE_SQL = None  # trained verdicts and MinHash cannot be written in SQL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passage_dedup.cut_repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality), ("toxicity", clean), ("near-dedup", near_duplicates),
          ("substring dedup", passages), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; every result but the last is written to
    the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = write_stage(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
