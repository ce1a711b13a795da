"""Model-quality and decision-threshold queries on (Churn, churn_probability)."""
from __future__ import annotations

from pyspark.sql import functions as F

from keepwise.config import Economics
from keepwise.operators import metrics as M
from keepwise.operators import threshold as TH
from keepwise.plans.base import featured_base
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import d, with_base

ECON = Economics()


def _confusion_sql(t_expr: str) -> str:
    return f"""
SELECT ROUND({t_expr}, 6) AS threshold,
  ROUND(CASE WHEN n > 0 THEN (tp + tn) * 1e0 / n ELSE 0e0 END, 6) AS accuracy,
  ROUND(CASE WHEN tp + fp > 0 THEN tp * 1e0 / (tp + fp) ELSE 0e0 END, 6) AS precision,
  ROUND(CASE WHEN tp + fn > 0 THEN tp * 1e0 / (tp + fn) ELSE 0e0 END, 6) AS recall,
  ROUND(CASE WHEN 2 * tp + fp + fn > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0e0 END, 6) AS f1,
  ROUND(brier, 6) AS brier, tn, fp, fn, tp,
  ROUND(CASE WHEN tn + fp > 0 THEN tn * 1e0 / (tn + fp) ELSE 0e0 END, 6) AS specificity
FROM (SELECT CAST(COUNT(*) FILTER (WHERE churn_probability >= {t_expr} AND Churn = 1) AS BIGINT) AS tp,
        CAST(COUNT(*) FILTER (WHERE churn_probability >= {t_expr} AND Churn = 0) AS BIGINT) AS fp,
        CAST(COUNT(*) FILTER (WHERE churn_probability < {t_expr} AND Churn = 1) AS BIGINT) AS fn,
        CAST(COUNT(*) FILTER (WHERE churn_probability < {t_expr} AND Churn = 0) AS BIGINT) AS tn,
        COUNT(*) AS n, AVG(POWER(churn_probability - Churn, 2)) AS brier FROM sb) c"""


def _confusion_out(df):
    return df.select(*[r6(c).alias(c) if c in ("threshold", "accuracy", "precision", "recall", "f1",
                                               "brier", "specificity") else F.col(c)
                       for c in df.columns])


@register("confusion_metrics", with_base(_confusion_sql("0.5e0")))
def q_confusion_metrics(spark, sf):
    return _confusion_out(M.confusion_metrics(featured_base(spark, sf), 0.5))


@register("brier", with_base("SELECT ROUND(AVG(POWER(churn_probability - Churn, 2)), 6) AS brier FROM sb"))
def q_brier(spark, sf):
    return featured_base(spark, sf).agg(r6(F.avg((F.col("churn_probability") - F.col("Churn")) ** 2))
                                        .alias("brier"))


_CURVE_SCORES = """
sb_s AS (SELECT ROUND(churn_probability, 12) AS score, COUNT(*) FILTER (WHERE Churn = 1) AS n_pos,
           COUNT(*) FILTER (WHERE Churn = 0) AS n_neg FROM sb GROUP BY 1),
sb_sc AS (SELECT *, SUM(n_pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
            SUM(n_neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn FROM sb_s),
sb_tot AS (SELECT SUM(n_pos) AS pp, SUM(n_neg) AS nn FROM sb_s)"""

_SCORES = """
sb_s AS (SELECT churn_probability AS score, COUNT(*) FILTER (WHERE Churn = 1) AS n_pos,
           COUNT(*) FILTER (WHERE Churn = 0) AS n_neg FROM sb GROUP BY churn_probability),
sb_sc AS (SELECT *, SUM(n_pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
            SUM(n_neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn FROM sb_s),
sb_tot AS (SELECT SUM(n_pos) AS pp, SUM(n_neg) AS nn FROM sb_s)"""


@register("roc_auc", with_base("""
SELECT ROUND(SUM(n_neg * (cp - n_pos + n_pos * 0.5e0)) / (SUM(n_pos) * SUM(n_neg) * 1e0), 6) AS roc_auc
FROM sb_sc""", _SCORES))
def q_roc_auc(spark, sf):
    return M.ranking_metrics(featured_base(spark, sf)).select(r6("roc_auc").alias("roc_auc"))


@register("average_precision", with_base("""
SELECT ROUND(SUM(n_pos * cp * 1e0 / (cp + cn)) / SUM(n_pos), 6) AS pr_auc FROM sb_sc""", _SCORES))
def q_average_precision(spark, sf):
    return M.ranking_metrics(featured_base(spark, sf)).select(r6("pr_auc").alias("pr_auc"))


@register("roc_curve", with_base("""
SELECT ROUND(score, 6) AS threshold, ROUND(cp * 1e0 / (SELECT pp FROM sb_tot), 6) AS tpr,
  ROUND(cn * 1e0 / (SELECT nn FROM sb_tot), 6) AS fpr
FROM sb_sc""", _CURVE_SCORES))
def q_roc_curve(spark, sf):
    c = M.curve_points(featured_base(spark, sf))
    return c.select(r6("threshold").alias("threshold"), r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


@register("pr_curve", with_base("""
SELECT ROUND(score, 6) AS threshold, ROUND(cp * 1e0 / (cp + cn), 6) AS precision,
  ROUND(cp * 1e0 / (SELECT pp FROM sb_tot), 6) AS recall
FROM sb_sc""", _CURVE_SCORES))
def q_pr_curve(spark, sf):
    c = M.curve_points(featured_base(spark, sf))
    return c.select(r6("threshold").alias("threshold"), r6("precision").alias("precision"),
                    r6("recall").alias("recall"))


@register("calibration_curve", with_base("""
SELECT CAST(""" + " + ".join(f"CASE WHEN churn_probability > (SELECT e[{j}] FROM sb_ce) THEN 1 ELSE 0 END"
                             for j in range(1, 10)) + """ AS INT) AS bin,
  CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(churn_probability), 6) AS mean_predicted,
  ROUND(AVG(Churn), 6) AS fraction_positive
FROM sb GROUP BY 1""", "sb_ce AS (SELECT QUANTILE_CONT(churn_probability, ["
                       + ", ".join(d(j / 10) for j in range(1, 10))
                       + "]) AS e FROM sb)"))
def q_calibration_curve(spark, sf):
    c = M.calibration_curve(featured_base(spark, sf))
    return c.select("bin", "n", r6("mean_predicted").alias("mean_predicted"),
                    r6("fraction_positive").alias("fraction_positive"))


_PROFIT_COEF = d(ECON.offer_success_rate * ECON.customer_value - ECON.retention_offer_cost)
_COST = d(ECON.retention_offer_cost)
_CURVE = f"""
sb_grid AS (SELECT CAST(i AS INT) AS i, i * 0.01e0 AS t FROM range(0, 101) r(i)),
sb_pc AS (
  SELECT g.i, g.t, CAST(COUNT(s.Churn) FILTER (WHERE s.Churn = 1) AS BIGINT) AS tp,
    CAST(COUNT(s.Churn) FILTER (WHERE s.Churn = 0) AS BIGINT) AS fp
  FROM sb_grid g LEFT JOIN sb s ON s.churn_probability >= g.t GROUP BY g.i, g.t),
sb_pp AS (SELECT i, t, tp, fp, tp * {_PROFIT_COEF} - fp * {_COST} AS profit FROM sb_pc)"""


@register("profit_curve", with_base("""
SELECT ROUND(t, 6) AS threshold, tp, fp, ROUND(profit, 4) AS profit FROM sb_pp""", _CURVE))
def q_profit_curve(spark, sf):
    c = TH.profit_curve(featured_base(spark, sf), ECON)
    return c.select(r6("threshold").alias("threshold"), "tp", "fp", r6("profit", 4).alias("profit"))


@register("optimal_threshold", with_base(f"""
SELECT ROUND(b.t, 6) AS best_threshold, ROUND(b.profit, 4) AS best_profit, 0.5e0 AS baseline_threshold,
  ROUND((SELECT profit FROM sb_pp WHERE i = 50), 4) AS baseline_profit,
  ROUND((SELECT profit FROM sb_pp WHERE i = 0), 4) AS treat_all_profit,
  ROUND(b.profit - (SELECT profit FROM sb_pp WHERE i = 50), 4) AS profit_uplift_vs_default,
  ROUND({d(ECON.customer_value)}, 6) AS customer_value, {_COST} AS retention_offer_cost,
  {d(ECON.offer_success_rate)} AS offer_success_rate
FROM (SELECT * FROM sb_pp ORDER BY profit DESC, i LIMIT 1) b""", _CURVE))
def q_optimal_threshold(spark, sf):
    o = TH.optimize_threshold(featured_base(spark, sf), ECON)
    return o.select(r6("best_threshold").alias("best_threshold"), r6("best_profit", 4).alias("best_profit"),
                    "baseline_threshold", r6("baseline_profit", 4).alias("baseline_profit"),
                    r6("treat_all_profit", 4).alias("treat_all_profit"),
                    r6("profit_uplift_vs_default", 4).alias("profit_uplift_vs_default"),
                    r6("customer_value").alias("customer_value"), "retention_offer_cost",
                    "offer_success_rate")


@register("metrics_at_optimal_threshold", with_base(_confusion_sql(
    "(SELECT t FROM sb_pp ORDER BY profit DESC, i LIMIT 1)"), _CURVE))
def q_metrics_at_optimal_threshold(spark, sf):
    f = featured_base(spark, sf)
    best = TH.optimize_threshold(f, ECON).select("best_threshold")
    t = best.first()["best_threshold"]   # one scalar from a 101-row table
    return _confusion_out(M.confusion_metrics(f, t))


_BREAK_EVEN = ECON.retention_offer_cost / (ECON.offer_success_rate * ECON.customer_value)


@register("nearest_grid_profit", with_base(f"""
SELECT ROUND({d(_BREAK_EVEN)}, 6) AS break_even, ROUND(t, 6) AS nearest_threshold, ROUND(profit, 4) AS profit
FROM sb_pp ORDER BY ABS(t - {d(_BREAK_EVEN)}), i LIMIT 1""", _CURVE))
def q_nearest_grid_profit(spark, sf):
    """Profit at the grid point nearest to the single-offer break-even probability C / (s V)."""
    c = TH.profit_curve(featured_base(spark, sf), ECON)
    be = F.lit(_BREAK_EVEN)
    row = c.agg(F.min_by(F.struct("threshold", "profit"),
                         F.struct(F.abs(F.col("threshold") - be).alias("dist"), F.col("threshold").alias("t")))
                .alias("m"))
    return row.select(r6(be).alias("break_even"), r6("m.threshold").alias("nearest_threshold"),
                      r6("m.profit", 4).alias("profit"))
