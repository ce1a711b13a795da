"""The corpus pipeline: each stage takes the documents that the one before it kept.

``STAGES`` are (name, function(spark, docs, sf_dir) -> DataFrame); ``run`` writes
every stage's rows as Parquet and rereads them for the next one.

In every stage null and empty texts, whole texts of any length, rows that repeat an id or a text and
columns of any further name pass through as they are unless the stage's decision falls on them; all but the
last stage return the columns that came. Rows with a null doc_id are judged by their text like others, but are
nobody's near copy. Equal rows get equal decisions. An empty table gives an empty table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwise.llm import decontamination, mixing, near_dup, token_files, toxicity
from keepwise.llm.common import saved, table
from keepwise.llm.queries import tokenizer_file

TOXIC_FROM = 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled rows among the documents; documents scored 0.7 or more go.
    Null and empty texts have the score of a text without terms."""
    learn = toxicity.in_training()
    model = toxicity.fit_toxicity(docs.filter(learn), table(spark, sf_dir, "labels").filter(learn))
    return docs.filter(toxicity.toxic_score(model, docs["text"]) < TOXIC_FROM)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays: the smallest doc_id.
    Rows with a null doc_id stay; null, empty and blank texts are no copies of each other."""
    gone = near_dup.near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, once per pass of the schedule that takes them."""
    return mixing.mixed_documents(docs)


def token_files_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_digests(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("toxicity", without_toxic), ("near duplicates", without_near_copies), ("decontamination", without_benchmark),
          ("mixing", mixed), ("token files", token_files_of)]

# trained scores, MinHash components and tokenizer ids are beyond SQL: tests/llm checks the stages by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = saved(docs, f"stage{number}")
    return docs
