"""Classification metrics on (label, probability) columns.

Ranking metrics work on the table of distinct scores (one row per score with
positive/negative counts).  Cumulative counts over that table are computed by
``prefix_sums``: one distributed sort range-partitions the scores, each partition
is a bucket that gets its offset from a table with one row per bucket, and the
running sum inside a bucket is an ordinary window partitioned by the bucket.  No
step moves all rows into one task, and no edges pass through the driver.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwise.operators.quantile import exact_quantiles
from keepwise.session import materialize


def ordered(df: DataFrame, order_col: str, by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """``df`` sorted by group and ``order_col``, its range partitions numbered as buckets (``_bk``, order in ``_key``).

    NULL and NaN have no place in the order and are left out.  The sorted table is
    checkpointed once: running sums over it read the same buckets whatever executors are lost.
    """
    key = F.col(order_col).cast("double")
    work = df.where(key.isNotNull() & ~F.isnan(key)).withColumn("_key", -key if descending else key)
    work = work.orderBy(*by, "_key").withColumn("_bk", F.shiftright(F.monotonically_increasing_id(), 33))
    return materialize(work)


def running_sums(work: DataFrame, cols: Sequence[str], suffix: str = "_cum", by: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``cols`` over an ``ordered`` table, per ``by`` group."""
    by = list(by)
    totals = work.groupBy(*by, "_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    # one row per (group, bucket)
    before = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_bk", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0))
                                          .alias(f"_o_{c}") for c in cols])
    inside = Window.partitionBy(*by, "_bk").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    out = work.join(offsets, [*by, "_bk"])
    for c in cols:
        out = out.withColumn(c + suffix, F.col(f"_o_{c}") + F.sum(c).over(inside))
    return out.drop(*[f"_o_{c}" for c in cols])


def prefix_sums(df: DataFrame, order_col: str, cols: Sequence[str], descending: bool = False,
                suffix: str = "_cum", by: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order_col`` order, per ``by`` group (groups must not be NULL).

    ``order_col`` values must be distinct within a group.
    """
    return running_sums(ordered(df, order_col, by, descending), cols, suffix, by).drop("_key", "_bk")


def score_table(df: DataFrame, label: str = "Churn", prob: str = "churn_probability",
                resolution: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, n_pos, n_neg) per distinct score with descending cumulative counts.

    ``resolution`` (decimals) merges scores closer than float noise, so curve
    points do not depend on last-bit differences of ``exp`` implementations.
    Rows without a score or label (NULL, NaN) are no part of any ranking.
    """
    df = df.where(F.col(prob).isNotNull() & ~F.isnan(F.col(prob).cast("double")) & F.col(label).isNotNull())
    score = F.col(prob) if resolution is None else F.round(F.col(prob), resolution)
    agg = df.groupBy(*by, score.alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"))
    return cumulated(agg, by)


def cumulated(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, n_pos, n_neg), one row per score, with descending cumulative counts."""
    return prefix_sums(counts, "score", ["n_pos", "n_neg"], descending=True, by=by)


def ranking_metrics(df: DataFrame, label: str = "Churn", prob: str = "churn_probability",
                    by: Sequence[str] = ()) -> DataFrame:
    """Tie-aware ROC-AUC and step-wise average precision (one row per group)."""
    return ranking_of(score_table(df, label, prob, by=by), by)


def ranking_of(st: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``ranking_metrics`` from the table of cumulative counts."""
    pos_above = F.col("n_pos_cum") - F.col("n_pos")
    prec = F.col("n_pos_cum") / (F.col("n_pos_cum") + F.col("n_neg_cum"))
    agg = st.groupBy(*by).agg(F.sum(F.col("n_neg") * (pos_above + F.col("n_pos") * 0.5)).alias("_auc_num"),
                              F.sum(F.col("n_pos") * prec).alias("_ap_num"),
                              F.sum("n_pos").alias("_p"), F.sum("n_neg").alias("_n"))
    return agg.select(
        *by,
        F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_auc_num") / (F.col("_p") * F.col("_n")))
         .alias("roc_auc"),
        F.when(F.col("_p") > 0, F.col("_ap_num") / F.col("_p")).alias("pr_auc"))


def curve_points(df: DataFrame, label: str = "Churn", prob: str = "churn_probability",
                 resolution: int | None = 12) -> DataFrame:
    """ROC and PR points at every distinct score threshold (score >= threshold)."""
    scored = df.where(F.col(prob).isNotNull() & ~F.isnan(F.col(prob).cast("double")))
    tot = scored.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    n_pos, n_neg = float(tot["p"]), float(tot["n"])
    st = score_table(df, label, prob, resolution)
    tp, fp = F.col("n_pos_cum"), F.col("n_neg_cum")
    return st.select(F.col("score").alias("threshold"),
                     (tp / F.lit(n_pos) if n_pos else F.lit(None).cast("double")).alias("tpr"),
                     (fp / F.lit(n_neg) if n_neg else F.lit(None).cast("double")).alias("fpr"),
                     (tp / (tp + fp)).alias("precision"),
                     (tp / F.lit(n_pos) if n_pos else F.lit(None).cast("double")).alias("recall"))


def confusion_metrics(df: DataFrame, threshold: float | Column, label: str = "Churn",
                      prob: str = "churn_probability") -> DataFrame:
    """Confusion counts and threshold metrics (0 on empty denominators) plus Brier."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(prob) >= t
    y1, y0 = F.col(label) == 1, F.col(label) == 0
    a = df.agg(F.count_if(pred & y1).alias("tp"), F.count_if(pred & y0).alias("fp"),
               F.count_if(~pred & y1).alias("fn"), F.count_if(~pred & y0).alias("tn"),
               F.avg((F.col(prob) - F.col(label)) ** 2).alias("brier"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(a_: Column, b_: Column) -> Column:
        return F.when(b_ > 0, a_ / b_).otherwise(F.lit(0.0))

    return a.select(t.cast("double").alias("threshold"),
                    ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                    ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), "brier",
                    "tn", "fp", "fn", "tp", ratio(tn, tn + fp).alias("specificity"))


def calibration_curve(df: DataFrame, label: str = "Churn", prob: str = "churn_probability",
                      n_bins: int = 10) -> DataFrame:
    """Quantile-binned reliability table: mean prediction vs observed rate per bin.

    Bin of p = number of inner edges strictly below p (right-closed bins);
    empty bins are absent.
    """
    edges = exact_quantiles(df, prob, [i / n_bins for i in range(n_bins + 1)])
    inner = edges[1:-1]
    b = sum((F.when(F.col(prob) > F.lit(float(e)), 1).otherwise(0) for e in inner), F.lit(0))
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"),
                                          F.avg(prob).alias("mean_predicted"),
                                          F.avg(label).alias("fraction_positive"))
