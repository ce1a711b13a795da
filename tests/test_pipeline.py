"""End-to-end contracts: split, training and scoring, persistence, streaming,
report sinks, the driver entry points."""
import glob
import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keepwise.models.pipeline import CATEGORICAL, NUMERIC
from keepwise.operators.value import with_value_at_risk
from keepwise.plans import q_ml
from keepwise.plans.base import featured_base, raw_base
from keepwise.plans.catalog import ORACLE, QUERIES, load_all

load_all()

ROWS_ONLY_FAST = ["categorical_association", "numeric_significance", "cox_hazard_ratios", "kmeans_segments", "strategy_matrix_kmeans",
                  "calibrated_scores", "validation_threshold", "test_metrics", "batch_scores",
                  "scenario_scores", "linear_attributions", "top_reasons"]
ROWS_ONLY_SLOW = ["bakeoff_leaderboard", "permutation_importance"]
ROWS_ONLY_FAST += ["executive_summary_model", "explained_test_rows"]


def test_clean_target_binary_and_no_nulls(spark, sf_dir):
    f = featured_base(spark, sf_dir)
    assert {r[0] for r in f.select("Churn").distinct().collect()} <= {0, 1}
    assert f.where(F.col("TotalCharges").isNull()).count() == 0
    for c in ["num_services", "tenure_group", "is_month_to_month"]:
        assert c in f.columns


def test_split_is_stratified_disjoint_complete(spark, sf_dir):
    s = q_ml.split_table(spark, sf_dir)
    n = featured_base(spark, sf_dir).count()
    assert s.count() == n
    assert s.select("customerID").distinct().count() == n
    rates = [r["churn_rate"] for r in s.groupBy("split").agg(F.avg("Churn").alias("churn_rate")).collect()]
    assert max(rates) - min(rates) < 0.02
    sizes = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert abs(sizes["test"] - 0.2 * n) <= 2 and abs(sizes["val"] - 0.2 * n) <= 2
    folds = s.where("split = 'train'").groupBy("fold").count().collect()
    assert len(folds) == 5 and max(r["count"] for r in folds) - min(r["count"] for r in folds) <= 2


def test_model_trains_scores_and_persists(spark, sf_dir, tmp_dir):
    data, scorer = q_ml.trained(spark, sf_dir)
    test = scorer.model.transform(data.where("split = 'test'"))
    n_test = data.where("split = 'test'").count()
    assert test.count() == n_test
    assert test.where((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0
    path = os.path.join(tmp_dir, "scorer")
    scorer.save(path)
    from keepwise.models.scoring import ChurnScorer
    again = ChurnScorer.load(path)
    raw = raw_base(spark, sf_dir).drop("Churn")
    a = scorer.score(raw).select("customerID", F.col("churn_probability").alias("a"))
    b = again.score(raw).select("customerID", F.col("churn_probability").alias("b"))
    diff = a.join(b, "customerID").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert diff < 1e-12
    assert again.threshold == scorer.threshold


def test_streaming_scores_equal_batch(spark, sf_dir, tmp_dir):
    from keepwise.sources.tables import RAW_COLUMNS
    from keepwise.streaming.scoring import start_scoring
    _, scorer = q_ml.trained(spark, sf_dir)
    src = os.path.join(tmp_dir, "incoming")
    raw = raw_base(spark, sf_dir).select(*RAW_COLUMNS)
    raw.write.parquet(src)
    q = start_scoring(spark, scorer, src, os.path.join(tmp_dir, "scored"), os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(tmp_dir, "scored"))
    batch = scorer.score(raw.drop("Churn")).select("customerID", F.col("churn_probability").alias("b"))
    j = streamed.join(batch, "customerID")
    assert j.count() == raw.count()
    assert j.agg(F.max(F.abs(F.col("churn_probability") - F.col("b")))).first()[0] < 1e-12


def test_report_sinks(spark, sf_dir, tmp_dir):
    from keepwise.sources.sinks import build_processed_dataset, write_dict, write_report
    out = write_report(QUERIES["policy_summary"](spark, sf_dir), os.path.join(tmp_dir, "policy"))
    assert len(glob.glob(os.path.join(out, "part-*.csv"))) == 1
    write_dict(spark, {"a": 1.5}, os.path.join(tmp_dir, "summary"))
    from keepwise.sources.sinks import write_record
    rec = write_record(QUERIES["optimal_threshold"](spark, sf_dir), os.path.join(tmp_dir, "threshold"))
    assert spark.read.json(rec).count() == 1
    assert glob.glob(os.path.join(tmp_dir, "summary", "part-*"))
    processed = build_processed_dataset(raw_base(spark, sf_dir), os.path.join(tmp_dir, "processed"))
    assert processed.count() == raw_base(spark, sf_dir).count()


def test_leakage_guard(spark, sf_dir):
    leaks = QUERIES["leakage_guard"](spark, sf_dir).where("leaks").count()
    assert leaks == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "priority_rank" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ROWS_ONLY_FAST)
def test_rows_only_queries_run(spark, sf_dir, name):
    assert name not in ORACLE
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name, rows", list(zip(ROWS_ONLY_SLOW, [3, len(NUMERIC + CATEGORICAL)])))
def test_bakeoff_and_importance_run(spark, sf_dir, name, rows):
    assert QUERIES[name](spark, sf_dir).count() == rows


def test_executive_summary_of_the_model(spark, sf_dir):
    """Headline values against pandas on the scored tables."""
    from keepwise.operators.policy import assign_actions, policy_summary
    got = QUERIES["executive_summary_model"](spark, sf_dir).first()
    data, scorer = q_ml.trained(spark, sf_dir)
    test = scorer.model.transform(data.where("split = 'test'")).select("Churn", "churn_probability").toPandas()
    hit = test.churn_probability >= got["optimal_threshold"]
    assert got["test_recall_at_optimal_threshold"] == pytest.approx((hit & (test.Churn == 1)).sum() / (test.Churn == 1).sum())
    order = test.sort_values("churn_probability", ascending=False).groupby("churn_probability", sort=False).Churn.agg(["sum", "count"]).cumsum()
    gained = order["sum"].diff().fillna(order["sum"])
    assert got["test_pr_auc"] == pytest.approx((gained * order["sum"] / order["count"]).sum() / test.Churn.sum())
    assert got["optimal_threshold"] == scorer.threshold and 2 <= got["segments"] <= 4
    scored = scorer.model.transform(featured_base(spark, sf_dir).drop("churn_probability"))
    summary = {r["action"]: r for r in policy_summary(assign_actions(with_value_at_risk(scored))).collect()}
    assert [got[f"policy_n_{a}"] for a in ("call", "discount", "do_nothing")] == [summary[a]["n_customers"] if a in summary else 0 for a in ("call", "discount", "do_nothing")]
    assert got["policy_n_call"] + got["policy_n_discount"] + got["policy_n_do_nothing"] == scored.count()


def test_explained_rows_add_up(spark, sf_dir):
    """Attributions plus the score of the mean row give the member's log-odds."""
    rows = QUERIES["explained_test_rows"](spark, sf_dir).collect()
    data, scorer = q_ml.trained(spark, sf_dir)
    n_test = data.where("split = 'test'").count()
    assert len(rows) == min(300, n_test) and all(0 <= r["churn_probability"] <= 1 for r in rows)
    odds = {r["customerID"]: r["m"] for r in scorer.model.members[0][0].transform(data.where("split = 'test'")).select(
        "customerID", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    base = [odds[r["customerID"]] - sum(a["attribution"] for a in r["attributions"]) for r in rows]
    assert max(base) - min(base) < 1e-9
    assert all(len(r["top_reasons"]) == 3 for r in rows)


def test_every_query_is_tested():
    covered = set(ORACLE) | set(ROWS_ONLY_FAST) | set(ROWS_ONLY_SLOW)
    assert set(QUERIES) == covered


def test_report_runner_writes_every_report(spark, sf_dir, tmp_dir):
    from keepwise.models.pipeline import ModelParams
    from keepwise.plans.report import run_reports
    summary = run_reports(spark, sf_dir, tmp_dir, ModelParams(rf_trees=10, gbt_rounds=10), folds=2)
    for name in ["leaderboard", "metrics_report", "eda_categorical_association", "eda_numeric_significance",
                 "profit_curve", "feature_importance", "median_survival_by_contract", "cox_hazard_ratios",
                 "top_value_at_risk", "retention_strategy_matrix", "uplift_targets",
                 "intervention_policy_summary", "intervention_recommendations", "executive_summary", "model"]:
        assert os.path.isdir(os.path.join(tmp_dir, name)), name
    assert summary["policy_band_do_nothing_to_discount"] <= summary["policy_band_discount_to_call"]
    assert summary["policy_total_expected_value"] >= 0


def test_csv_scan_with_fixed_schema_and_subset_check(spark, sf_dir, tmp_dir):
    from keepwise.sources.tables import RAW_COLUMNS, read_customer_csv, require_columns
    raw = raw_base(spark, sf_dir).select(*RAW_COLUMNS)
    path = os.path.join(tmp_dir, "raw_csv")
    raw.write.option("header", True).csv(path)
    back = read_customer_csv(spark, path)
    assert back.count() == raw.count()
    assert dict(back.dtypes)["TotalCharges"] == "string"        # blanks survive the scan
    # the CSV writer trims the blank totals to empty (read back as NULL); both are unparseable -> 0.0
    from keepwise.operators.clean import lenient_double
    assert back.where(lenient_double("TotalCharges").isNull()).count() == \
        raw.where(lenient_double("TotalCharges").isNull()).count()
    with pytest.raises(ValueError):
        require_columns(raw.drop("Contract"))


def test_preprocessor_maps_unseen_levels_to_all_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from keepwise.models.pipeline import preprocessor_stages
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (None, "a"), (4.0, None)], "x double, c string")
    model = Pipeline(stages=preprocessor_stages(["x"], ["c"])).fit(train)
    rows = {r["c"]: r["v"] for r in model.transform(
        spark.createDataFrame([(3.0, "a"), (3.0, "b"), (3.0, "zzz"), (None, None)], "x double, c string"))
        .select("c", vector_to_array("features").alias("v")).collect()}
    assert rows["a"][1:] == [1.0, 0.0] and rows["b"][1:] == [0.0, 1.0]
    assert rows["zzz"][1:] == [0.0, 0.0]                 # unseen level -> all zeros
    assert rows[None][1:] == [1.0, 0.0]                  # missing level -> training mode ("a")
    # missing numeric -> training median (2.0) before scaling; same scaled value as an explicit 2.0
    two = model.transform(spark.createDataFrame([(2.0, "a")], "x double, c string")) \
        .select(vector_to_array("features").alias("v")).first()["v"][0]
    assert rows[None][0] == pytest.approx(two)


def test_uplift_budget_flags_exactly_the_budget(spark, sf_dir):
    u = QUERIES["uplift_budget"](spark, sf_dir)
    n = u.count()
    assert u.where("target").count() == max(1, int(n * 0.2))
    ranks = sorted(r[0] for r in u.select("uplift_rank").collect())
    assert ranks == list(range(1, n + 1))
    # every targeted customer has an uplift score >= every untargeted one
    lo_t = u.where("target").agg(F.min("uplift_score")).first()[0]
    hi_u = u.where("NOT target").agg(F.max("uplift_score")).first()[0]
    assert lo_t >= hi_u
