"""Model-based queries (checked by row counts and the invariant tests; the
learned numbers have no SQL formulation; the split and its folds have one).

One calibrated logistic model is trained per input folder and shared by the
scoring, threshold and explanation queries.  The registered bake-off runs
``ModelParams()`` as it is; every training row is held out once (5 folds).
"""
from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import functions as F

from keepwise.config import DEFAULT, Economics
from keepwise.models import explain as X
from keepwise.models.calibrate import calibrate
from keepwise.models.linear import Encoder
from keepwise.models.pipeline import CATEGORICAL, NUMERIC, ModelParams, with_label
from keepwise.models.prepare import fit_preprocessors
from keepwise.models.scoring import ChurnScorer
from keepwise.models.selection import CANDIDATES, bakeoff
from keepwise.models.smote import oversample
from keepwise.models.split import split_summary, stratified_split
from keepwise.operators import metrics as M
from keepwise.operators import threshold as TH
from keepwise.operators.features import add_row_features, fit_premium_threshold, premium_flag
from keepwise.operators.ranking import top_k
from keepwise.operators.segments import kmeans_segments, strategy_matrix
from keepwise.operators.value import with_value_at_risk
from keepwise.plans.base import cleaned_base, featured_base, raw_base
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import with_base
from keepwise.session import written

ECON = Economics()
_CACHE: dict = {}
_LOCK = threading.RLock()     # one training per folder even when queries run in parallel threads


def _ctx(spark) -> int:
    """Cached DataFrames belong to one SparkContext; a restarted session gets fresh ones."""
    return spark.sparkContext.applicationId


def split_table(spark, sf):
    key = ("split", sf, _ctx(spark))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = written(add_row_features(stratified_split(cleaned_base(spark, sf).drop("churn_probability"))), "split")
        return _CACHE[key]


def trained(spark, sf):
    """(prepared split table, calibrated scorer) — fitted once per folder."""
    key = ("model", sf, _ctx(spark))
    with _LOCK:
        if key not in _CACHE:
            data = with_label(split_table(spark, sf))
            model = calibrate(data.where(F.col("split") == "train"), "logistic_regression", ModelParams())
            val = model.transform(data.where(F.col("split") == "val"))
            t = TH.optimize_threshold(val, ECON).first()["best_threshold"]
            _CACHE[key] = (data, ChurnScorer(model, t))
        return _CACHE[key]


# The split's own SQL: exact class sizes, positions by the digest of the id.
_PLACED = """
sp_pos AS (
  SELECT customerID, Churn, COUNT(*) OVER (PARTITION BY Churn) AS nc,
    ROW_NUMBER() OVER (PARTITION BY Churn ORDER BY md5(customerID || '|{seed}'), customerID) AS pos
  FROM sb_clean
),
sp_test AS (
  SELECT *, CAST(CEIL(CAST('{test!r}' AS DOUBLE) * nc) AS BIGINT) AS nt FROM sp_pos
),
sp_size AS (
  SELECT *, CAST(CEIL(CAST('{val!r}' AS DOUBLE) * (nc - nt)) AS BIGINT) AS nv FROM sp_test
),
sp AS (
  SELECT customerID, Churn,
    CASE WHEN pos <= nt THEN 'test' WHEN pos <= nt + nv THEN 'val' ELSE 'train' END AS split,
    CASE WHEN pos > nt + nv THEN CAST((pos - nt - nv - 1) % {folds} AS INT) END AS fold
  FROM sp_size
)""".format(seed=DEFAULT.seed, test=DEFAULT.test_size, val=DEFAULT.validation_size / (1.0 - DEFAULT.test_size),
            folds=DEFAULT.cv_folds)


def _split_sql(body: str) -> str:
    return with_base(body, _PLACED)


@register("stratified_split", _split_sql(
    "SELECT customerID, Churn, split, COALESCE(fold, -1) AS fold FROM sp"))
def q_stratified_split(spark, sf):
    """Every customer's split and fold (-1 outside the training rows)."""
    return split_table(spark, sf).select("customerID", "Churn", "split", F.coalesce("fold", F.lit(-1)).alias("fold"))


@register("split_summary", _split_sql(
    "SELECT split, COUNT(*) AS n, ROUND(AVG(Churn), 6) AS churn_rate FROM sp GROUP BY split"))
def q_split_summary(spark, sf):
    return split_summary(split_table(spark, sf)).withColumn("churn_rate", r6("churn_rate"))


@register("kfold_assignment", _split_sql(
    "SELECT fold, Churn, COUNT(*) AS n FROM sp WHERE split = 'train' GROUP BY fold, Churn"))
def q_kfold_assignment(spark, sf):
    s = split_table(spark, sf).where(F.col("split") == "train")
    return s.groupBy("fold", "Churn").agg(F.count(F.lit(1)).alias("n"))


@register("smote_balance", _split_sql("""
SELECT fold, Churn, MAX(n) OVER (PARTITION BY fold) AS n, MAX(n) OVER (PARTITION BY fold) - n AS n_synthetic
FROM (SELECT k.fold, s.Churn, COUNT(*) AS n
      FROM (SELECT DISTINCT fold FROM sp WHERE split = 'train') k JOIN sp s ON s.split = 'train' AND s.fold <> k.fold
      GROUP BY k.fold, s.Churn) c"""))
def q_smote_balance(spark, sf):
    """Class counts after oversampling each fold's fitting rows (encoded by that fold's preprocessor)."""
    train = split_table(spark, sf).where(F.col("split") == "train")
    parts = []
    for k, ready in enumerate(fit_preprocessors(train, range(DEFAULT.cv_folds))):
        encoded = Encoder.of(ready.stages).features(with_label(train.where(F.col("fold") != k)))
        # encoded once: oversampling counts the classes, reads the minority and returns all rows
        encoded = written(encoded.select(DEFAULT.id_col, "features", "label"), "encoded")
        parts.append(oversample(encoded).groupBy(F.lit(k).alias("fold"), F.col("label").cast("int").alias("Churn"))
                     .agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("n_synthetic")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("explanation_sample_test", with_base("""
SELECT customerID, b.Churn, tenure, Contract, num_services
FROM sb b JOIN sp USING (customerID) WHERE sp.split = 'test' ORDER BY customerID LIMIT 300""", _PLACED))
def q_explanation_sample_test(spark, sf):
    """The 300 test rows that are explained (first by id)."""
    test = split_table(spark, sf).where(F.col("split") == "test")
    return top_k(test, [F.col("customerID")], 300).select("customerID", "Churn", "tenure", "Contract", "num_services")


@register("bakeoff_leaderboard")
def q_bakeoff_leaderboard(spark, sf):
    board, _ = bakeoff(split_table(spark, sf), CANDIDATES, ModelParams(), folds=5)
    return board


@register("validation_threshold")
def q_validation_threshold(spark, sf):
    data, scorer = trained(spark, sf)
    val = scorer.model.transform(data.where(F.col("split") == "val"))
    return TH.optimize_threshold(val, ECON)


@register("calibrated_scores")
def q_calibrated_scores(spark, sf):
    data, scorer = trained(spark, sf)
    out = scorer.model.transform(data.where(F.col("split") == "test"))
    return out.select("customerID", "Churn", "churn_probability")


@register("test_metrics")
def q_test_metrics(spark, sf):
    """Metric records on the test split at 0.5 and at the validation-optimal threshold."""
    data, scorer = trained(spark, sf)
    test = scorer.model.transform(data.where(F.col("split") == "test")).select("Churn", "churn_probability")
    rank = M.ranking_metrics(test).withColumn("_k", F.lit(1))
    rows = [M.confusion_metrics(test, 0.5), M.confusion_metrics(test, scorer.threshold)]
    out = rows[0].unionByName(rows[1]).withColumn("_k", F.lit(1))
    return out.join(rank, "_k").drop("_k")


@register("batch_scores")
def q_batch_scores(spark, sf):
    """Score the raw (uncleaned) customer table end to end with the fitted scorer."""
    _, scorer = trained(spark, sf)
    return scorer.score(raw_base(spark, sf)).select("customerID", "churn_probability", "risk_flag", "risk_tier")


@register("scenario_scores")
def q_scenario_scores(spark, sf):
    _, scorer = trained(spark, sf)
    return scorer.score_scenarios(raw_base(spark, sf)).select(
        "customerID", "scenario", "churn_probability", "risk_flag", "risk_tier")


@register("kmeans_segments")
def q_kmeans_segments(spark, sf):
    return kmeans_segments(featured_base(spark, sf)).select("customerID", "segment")


@register("strategy_matrix_kmeans")
def q_strategy_matrix_kmeans(spark, sf):
    seg = kmeans_segments(with_value_at_risk(featured_base(spark, sf), ECON))
    return strategy_matrix(seg)


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    data, scorer = trained(spark, sf)
    # the flag is a feature like any other here: given, so that its permutation counts
    limit = fit_premium_threshold(data.where(F.col("split") == "train"))
    test = data.where(F.col("split") == "test").withColumn("is_premium", premium_flag(F.col("MonthlyCharges"), limit))
    return X.permutation_importance(scorer.model, test, NUMERIC + CATEGORICAL)


def _attributions(spark, sf):
    data, scorer = trained(spark, sf)
    pipe = scorer.model.members[0][0]
    base = featured_base(spark, sf).drop("churn_probability")
    return X.linear_attributions(pipe, data.where(F.col("split") == "train"), base, NUMERIC, CATEGORICAL)


@register("linear_attributions")
def q_linear_attributions(spark, sf):
    return X.mean_abs_attribution(_attributions(spark, sf))


@register("top_reasons")
def q_top_reasons(spark, sf):
    return _attributions(spark, sf).select("customerID", "top_reasons")
