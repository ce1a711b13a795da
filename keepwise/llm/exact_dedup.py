"""Exact duplicates: group by a 128-bit content hash, then compare the bytes inside each group.

DataFrame operations only. A hot group (one text in a third of all rows) is
aggregated and joined back through (hash, salt), so no task holds it whole.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwise.llm.common import fan_out, per_key, salted, saved

_BLANKS = " \t\n\x0b\x0c\r"
_SALTS = 1024


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _BLANKS, "")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _groups(rows: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    best = F.max(F.struct("chars", F.negative("doc_id").alias("minus_id")))
    groups, pairs = per_key(rows, key, [best.alias("best"), F.count("*").alias("size")],
                            [F.max("best").alias("best"), F.sum("size").alias("group_size")])
    return groups.select(*key, F.negative("best.minus_id").alias("keep_id"), "group_size"), pairs


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space (null counts as
    empty). Of equal texts the one with the most code points, then the smallest
    doc_id, stays. Rows of one content hash whose bytes differ from those of the
    group's kept row are grouped anew by their bytes, so a collision never merges
    texts. Repeated rows of a doc_id share its fate; a null doc_id ranks last in
    its group and is kept only where it is alone. Other columns are ignored; an
    empty table gives an empty table.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), normalised(F.col("text")).alias("norm"))
    rows = salted(saved(texts.select("doc_id", "chars", content_hash(F.col("norm")).alias("hash"),
                                     F.sha2("norm", 256).alias("text_sha256")), "hashes"), "doc_id", _SALTS)
    groups, pairs = _groups(rows, ["hash"])
    groups = saved(groups, "groups")
    alone = (fan_out(rows, pairs, groups.hint("merge"), ["hash"]).filter("group_size = 1")
             .select("doc_id", "keep_id", "group_size", "text_sha256"))

    # these tables grow with the input, so they are shuffled at every size
    shared = saved(pairs.join(groups.filter("group_size > 1"), "hash"), "shared")
    members = saved(salted(texts.withColumn("hash", content_hash(F.col("norm"))), "doc_id", _SALTS)
                    .join(shared.hint("merge"), ["hash", "_salt"]).select("hash", "_salt", "doc_id", "chars", "norm", "keep_id"), "members")
    keepers = (members.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
               .groupBy("hash").agg(F.min("norm").alias("kept_norm")))
    compared = members.join(shared.select("hash", "_salt").join(keepers, "hash"), ["hash", "_salt"])
    variant = F.when(F.col("norm") == F.col("kept_norm"), F.lit("")).otherwise(F.concat(F.lit("="), F.col("norm")))
    checked = saved(compared.select("hash", "_salt", "doc_id", "chars", variant.alias("variant"),
                                    F.sha2("norm", 256).alias("text_sha256")), "checked")
    final, final_pairs = _groups(checked, ["hash", "variant"])
    together = fan_out(checked, final_pairs, final, ["hash", "variant"])
    out = alone.unionByName(together.select("doc_id", "keep_id", "group_size", "text_sha256"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
