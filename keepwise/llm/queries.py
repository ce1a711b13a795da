"""The operators' queries: name -> (spark, sf_dir) -> DataFrame, over their whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwise.llm import (decontamination, exact_dedup, hard_negatives, license_scan, mixing, near_dup, pii, secrets,
                          token_counts, token_files, toxicity, url_rules, whitening)
from keepwise.llm.common import saved, table
from keepwise.llm.oracles import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = toxicity.in_training()
    model = toxicity.fit_toxicity(docs.filter(learn), table(spark, sf_dir, "labels").filter(learn))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return (toxicity.score_documents(docs, model)
            .select("doc_id", held_out.alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))


@_query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85)


@_query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """first_slot: -1 where the mix takes nothing of a document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken",
                                                                F.coalesce("first_slot", F.lit(-1)).cast("long").alias("first_slot"))


@_query
def op5_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@_query
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@_query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@_query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@_query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no findings labelled by people: findings of two thirds of the documents are labelled
    by ``label_of`` where there is evidence, the forest judges all."""
    words = secrets.common_words(table(spark, sf_dir, "benchmark"))
    found = saved(secrets.find_candidates(table(spark, sf_dir, "documents"), words), "findings")
    return (secrets.scan_secrets(found, found.filter(toxicity.in_training()))
            .select("doc_id", "start", F.length("value").cast("long").alias("length"), "kind", F.sha2("value", 256).alias("value_sha256"), "score", "secret"))


@_query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.find_personal_data(table(spark, sf_dir, "documents")))


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined_negatives(table(spark, sf_dir, "embeddings"))


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_embeddings(table(spark, sf_dir, "embeddings"))
