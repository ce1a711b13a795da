"""Report outputs: the nested metrics record, the executive summary on the fitted model, the short lists and the explained rows."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwise.config import DEFAULT, Economics
from keepwise.models import explain as X
from keepwise.models.pipeline import CATEGORICAL, NUMERIC
from keepwise.operators import metrics as M
from keepwise.operators import policy as PO
from keepwise.operators import threshold as TH
from keepwise.operators import uplift as U
from keepwise.operators.ranking import top_k
from keepwise.operators.segments import kmeans_segments
from keepwise.operators.value import top_value_at_risk, value_at_risk_summary, with_value_at_risk
from keepwise.plans import q_ml
from keepwise.plans.base import featured_base, raw_base
from keepwise.plans.catalog import ORACLE, r6, register
from keepwise.plans.oracle import d, with_base
from keepwise.plans.q_core import _VAR_COLS, _var_out
from keepwise.plans.q_metrics import _CURVE, _SCORES
from keepwise.session import materialize, scratch_path
from keepwise.sources.sinks import write_record

ECON = Economics()

_THRESHOLD = ("struct<best_threshold:double,best_profit:double,baseline_threshold:double,baseline_profit:double,treat_all_profit:double,"
              "profit_uplift_vs_default:double,customer_value:double,retention_offer_cost:double,offer_success_rate:double>")
_METRICS = ("struct<threshold:double,accuracy:double,precision:double,recall:double,f1:double,brier:double,tn:long,fp:long,fn:long,tp:long,"
            "specificity:double,roc_auc:double,pr_auc:double>")
METRICS_REPORT = (f"best_model string, leaderboard array<struct<model:string,cv_score:double,val_pr_auc:double,val_roc_auc:double>>, "
                  f"threshold_optimization {_THRESHOLD}, test_metrics_default {_METRICS}, test_metrics_optimal {_METRICS}, "
                  f"n_train long, n_val long, n_test long, churn_rate double")


def metrics_report(spark: SparkSession, best_model: str, board: DataFrame, threshold: dict, test: DataFrame, split: DataFrame,
                   churn_rate: float, label: str = "Churn") -> DataFrame:
    """One nested row; ``board`` has a row per candidate, ``test`` the test rows' label and churn_probability."""
    rank = M.ranking_metrics(test, label).first().asDict()
    at = [{**M.confusion_metrics(test, t, label).first().asDict(), **rank} for t in (0.5, threshold["best_threshold"])]
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}        # one row per split
    row = (best_model, [tuple(r[c] for c in ("model", "cv_score", "val_pr_auc", "val_roc_auc")) for r in board.collect()], threshold, *at,
           *(sizes.get(s, 0) for s in ("train", "val", "test")), float(churn_rate))
    return spark.createDataFrame([row], METRICS_REPORT)


def executive_summary(best_model: str, report: dict, scored: DataFrame, summary: DataFrame, n_segments: int, n_persuadables: int, econ: Economics = ECON) -> dict:
    """The 15 headline values: ``report`` is a ``metrics_report`` row, ``scored`` the scored base with its value at risk, ``summary`` the policy's."""
    bands = scored.sparkSession.range(1).select(PO.band_boundaries(F.lit(econ.customer_value), econ).alias("b")).first()["b"]
    actions = {r["action"]: r for r in summary.collect()}                                     # one row per action
    best = report["test_metrics_optimal"]
    n = lambda action: actions[action]["n_customers"] if action in actions else 0
    return {
        "best_model": best_model, "test_pr_auc": best["pr_auc"], "test_roc_auc": best["roc_auc"], "test_recall_at_optimal_threshold": best["recall"],
        "optimal_threshold": report["threshold_optimization"]["best_threshold"],
        "profit_uplift_vs_default": report["threshold_optimization"]["profit_uplift_vs_default"],
        "total_expected_value_at_risk": value_at_risk_summary(scored).first()["total_value_at_risk"],
        "n_persuadables": n_persuadables, "segments": n_segments,
        "policy_band_do_nothing_to_discount": bands["do_nothing_to_discount"], "policy_band_discount_to_call": bands["discount_to_call"],
        "policy_n_call": n("call"), "policy_n_discount": n("discount"), "policy_n_do_nothing": n("do_nothing"),
        "policy_total_expected_value": sum(r["expected_value"] for r in actions.values()),
    }


SUMMARY = ("best_model string, test_pr_auc double, test_roc_auc double, test_recall_at_optimal_threshold double, optimal_threshold double, "
           "profit_uplift_vs_default double, total_expected_value_at_risk double, n_persuadables long, segments long, policy_band_do_nothing_to_discount double, "
           "policy_band_discount_to_call double, policy_n_call long, policy_n_discount long, policy_n_do_nothing long, policy_total_expected_value double")


@register("executive_summary_model")
def q_executive_summary_model(spark, sf):
    """The summary of the calibrated model: metrics on its test split, k-means segments, policy on the whole scored base."""
    data, scorer = q_ml.trained(spark, sf)
    val, test = (scorer.model.transform(data.where(F.col("split") == s)).select("Churn", "churn_probability") for s in ("val", "test"))
    threshold = TH.optimize_threshold(val, ECON).first().asDict()
    board = spark.createDataFrame([], "model string, cv_score double, val_pr_auc double, val_roc_auc double")
    report = metrics_report(spark, "logistic_regression", board, threshold, test, data, data.agg(F.avg("Churn")).first()[0]).first().asDict(recursive=True)
    scored = materialize(with_value_at_risk(scorer.model.transform(featured_base(spark, sf).drop("churn_probability")), ECON))
    segments = kmeans_segments(scored).select("segment").distinct().count()
    persuadable = U.uplift_scores(scored).where(F.col("persuadable_category") == U.CATEGORIES[0]).count()
    found = executive_summary("logistic_regression", report, scored, PO.policy_summary(PO.assign_actions(scored, ECON), ECON), segments, persuadable)
    return spark.createDataFrame([tuple(found[f.split()[0]] for f in SUMMARY.split(", "))], SUMMARY)


_T = "(SELECT t FROM sb_pp ORDER BY profit DESC, i LIMIT 1)"


def _recall(t: str) -> str:
    return f"(SELECT ROUND(COUNT(*) FILTER (WHERE Churn = 1 AND churn_probability >= {t}) * 1e0 / COUNT(*) FILTER (WHERE Churn = 1), 6) FROM sb)"


@register("metrics_report_round_trip", with_base(f"""
SELECT 'scorecard' AS best_model, 'scorecard' AS first_model,
  (SELECT ROUND(SUM(n_pos * cp * 1e0 / (cp + cn)) / SUM(n_pos), 6) FROM sb_sc) AS first_pr_auc,
  (SELECT ROUND(t, 6) FROM sb_pp ORDER BY profit DESC, i LIMIT 1) AS best_threshold,
  (SELECT ROUND(MAX(profit) - MAX(profit) FILTER (WHERE i = 50), 4) FROM sb_pp) AS profit_uplift_vs_default,
  ROUND({d(ECON.customer_value)}, 6) AS customer_value, {_recall('0.5e0')} AS recall_default, {_recall(_T)} AS recall_optimal,
  (SELECT ROUND(SUM(n_neg * (cp - n_pos + n_pos * 0.5e0)) / (SUM(n_pos) * SUM(n_neg) * 1e0), 6) FROM sb_sc) AS roc_auc,
  (SELECT CAST(COUNT(*) FILTER (WHERE split = 'train') AS BIGINT) FROM sp) AS n_train,
  (SELECT CAST(COUNT(*) FILTER (WHERE split = 'val') AS BIGINT) FROM sp) AS n_val,
  (SELECT CAST(COUNT(*) FILTER (WHERE split = 'test') AS BIGINT) FROM sp) AS n_test,
  (SELECT ROUND(AVG(Churn), 6) FROM sb) AS churn_rate""", _SCORES + "," + _CURVE + "," + q_ml._PLACED))
def q_metrics_report_round_trip(spark, sf):
    """The nested metrics record of the scorecard: written as JSON, read back under its schema, looked up inside."""
    f = featured_base(spark, sf)
    scores = M.ranking_metrics(f).select(F.lit("scorecard").alias("model"), F.lit(None).cast("double").alias("cv_score"),
                                         F.col("pr_auc").alias("val_pr_auc"), F.col("roc_auc").alias("val_roc_auc"))
    report = metrics_report(spark, "scorecard", scores, TH.optimize_threshold(f, ECON).first().asDict(), f.select("Churn", "churn_probability"),
                            q_ml.split_table(spark, sf), f.agg(F.avg("Churn")).first()[0])
    path = write_record(report, scratch_path(spark, f"metrics-report-{uuid.uuid4().hex[:12]}"))
    back = spark.read.schema(METRICS_REPORT).json(path)
    return back.select("best_model", F.col("leaderboard")[0]["model"].alias("first_model"), r6(F.col("leaderboard")[0]["val_pr_auc"]).alias("first_pr_auc"),
                       r6("threshold_optimization.best_threshold").alias("best_threshold"),
                       r6("threshold_optimization.profit_uplift_vs_default", 4).alias("profit_uplift_vs_default"),
                       r6("threshold_optimization.customer_value").alias("customer_value"), r6("test_metrics_default.recall").alias("recall_default"),
                       r6("test_metrics_optimal.recall").alias("recall_optimal"), r6("test_metrics_optimal.roc_auc").alias("roc_auc"),
                       "n_train", "n_val", "n_test", r6("churn_rate").alias("churn_rate"))


def _top(k: int):
    @register(f"value_at_risk_top{k}", ORACLE["value_at_risk_top"].replace("priority_rank <= 200", f"priority_rank <= {k}"))
    def query(spark, sf):
        return _var_out(top_value_at_risk(featured_base(spark, sf), k))

    return query


q_value_at_risk_top20, q_value_at_risk_top50 = _top(20), _top(50)     # the chart's and the dashboard's list


@register("explained_test_rows")
def q_explained_test_rows(spark, sf):
    """The 300 sampled test rows (first by id) with their score's attributions and main reasons."""
    data, scorer = q_ml.trained(spark, sf)
    rows = top_k(data.where(F.col("split") == "test"), [F.col(DEFAULT.id_col)], 300)
    told = X.linear_attributions(scorer.model.members[0][0], data.where(F.col("split") == "train"), rows, NUMERIC, CATEGORICAL)
    scores = scorer.score(raw_base(spark, sf).join(F.broadcast(rows.select(DEFAULT.id_col)), DEFAULT.id_col, "left_semi")).select(DEFAULT.id_col, "churn_probability")
    return told.join(scores, DEFAULT.id_col).select(DEFAULT.id_col, "churn_probability", "attributions", "top_reasons")
