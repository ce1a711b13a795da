"""Stratified train / validation / test split and stratified k-fold ids.

Rows are ordered inside each class by the MD5 digest of ``id|seed`` (ties by
id; every engine computes the same digest); the within-class position decides the split:
test = first ceil(test * n_c), validation = next ceil(val / (1 - test) * rest),
train = the remainder.  Fold ids for the training rows are position mod k.
Deterministic, exact sizes per class, no single-task window.  A digest's leading digits are its
bucket: one counting pass gives every bucket its offset, and rows are numbered inside
their bucket, so full rows are shuffled once and nothing is joined back.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepwise.config import DEFAULT, Settings

_DIGITS = 3               # of the digest: 4,096 buckets a class

def stratified_split(df: DataFrame, settings: Settings = DEFAULT, folds: int | None = None) -> DataFrame:
    """Add ``split`` (train / val / test) and ``fold`` (0..k-1 for train rows, else NULL)."""
    label, id_col, seed = settings.target_col, settings.id_col, settings.seed
    k = folds or settings.cv_folds
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))
    strat = F.col(label) if settings.stratify else F.lit(0)
    work = df.withColumns({"_stratum": strat, "_h": key})
    work = work.withColumn("_bucket", F.substring("_h", 1, _DIGITS))
    counts = work.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # at most 16 ** _DIGITS rows per class
    upto = F.sum("_n").over(Window.partitionBy("_stratum").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    sums = counts.select("_stratum", "_bucket", "_n", upto.alias("_upto")).collect()
    test_frac = settings.test_size
    val_rel = settings.validation_size / (1.0 - test_frac)
    totals: dict = {}
    for r in sums:
        totals[r["_stratum"]] = max(totals.get(r["_stratum"], 0), r["_upto"])
    sizes = {c: math.ceil(test_frac * n) for c, n in totals.items()}
    offsets = df.sparkSession.createDataFrame(
        [(r["_stratum"], r["_bucket"], r["_upto"] - r["_n"], sizes[r["_stratum"]], math.ceil(val_rel * (totals[r["_stratum"]] - sizes[r["_stratum"]])))
         for r in sums if r["_stratum"] is not None and r["_bucket"] is not None],
        "_stratum int, _bucket string, _off long, _nt long, _nv long")
    inside = Window.partitionBy("_stratum", "_bucket").orderBy("_h", id_col)
    # position inside the class, 1-based; rows without an id or class have none
    placed = work.withColumn("_r", F.row_number().over(inside)).join(F.broadcast(offsets), ["_stratum", "_bucket"])
    pos = F.col("_off") + F.col("_r")
    split = (F.when(pos <= F.col("_nt"), F.lit("test"))
              .when(pos <= F.col("_nt") + F.col("_nv"), F.lit("val"))
              .otherwise(F.lit("train")))
    fold = F.when(split == "train", ((pos - F.col("_nt") - F.col("_nv") - 1) % F.lit(k)).cast("int"))
    return placed.select(id_col, *[c for c in df.columns if c != id_col], split.alias("split"), fold.alias("fold"))


def split_summary(split_df: DataFrame, label: str = "Churn") -> DataFrame:
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("churn_rate"))
