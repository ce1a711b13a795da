"""End-to-end run: train, evaluate, analyse the scored base, write reports.

    python -m keepwise.plans.report --data /root/testdata/sf0.1 --out /shared/reports

One lazy plan up to the scored base; the scored base is checkpointed and
every analysis is a branch of it with one action (its report write).
"""
from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keepwise.config import Economics
from keepwise.models import explain as X
from keepwise.models.calibrate import calibrate
from keepwise.models.pipeline import CATEGORICAL, NUMERIC, ModelParams, with_label
from keepwise.models.scoring import ChurnScorer
from keepwise.models.selection import CANDIDATES, bakeoff
from keepwise.models.split import stratified_split
from keepwise.operators import policy as PO
from keepwise.operators import stats as S
from keepwise.operators import survival as SV
from keepwise.operators import threshold as TH
from keepwise.operators import uplift as U
from keepwise.operators.features import fit_premium_threshold, premium_flag
from keepwise.operators.ranking import top_k
from keepwise.operators.segments import kmeans_segments, strategy_matrix
from keepwise.operators.value import top_value_at_risk, with_value_at_risk
from keepwise.plans.base import featured_base
from keepwise.plans.q_profile import CATEGORICAL as EDA_CATEGORICAL
from keepwise.plans.q_profile import NUMERIC as EDA_NUMERIC
from keepwise.plans.q_report import executive_summary, metrics_report
from keepwise.session import materialize
from keepwise.sources.sinks import write_dict, write_record, write_report
from keepwise.sources.tables import select_present


def run_reports(spark: SparkSession, data_dir: str, out_dir: str, params: ModelParams = ModelParams(),
                candidates=CANDIDATES, folds: int = 5, econ: Economics = Economics()) -> dict:
    def out(name):
        return os.path.join(out_dir, name)

    featured = featured_base(spark, data_dir)
    model_input = featured.drop("churn_probability", "is_premium")       # models flag by their own threshold
    # 1-2: split, bake-off, calibration of the winner, threshold on validation
    split = materialize(stratified_split(model_input))
    board, _ = bakeoff(split, candidates, params, folds)
    board = board.cache()
    write_report(board, out("leaderboard"))
    best = board.first()["model"]
    data = with_label(split)
    model = calibrate(data.where(F.col("split") == "train"), best, params, folds)
    val = model.transform(data.where(F.col("split") == "val"))
    thr = TH.optimize_threshold(val, econ).first().asDict()
    test = model.transform(data.where(F.col("split") == "test")).select("Churn", "churn_probability")
    scorer = ChurnScorer(model, thr["best_threshold"])
    scorer.save(out("model"))
    record = metrics_report(spark, best, board, thr, test, split, featured.agg(F.avg("Churn")).first()[0]).cache()
    write_record(record, out("metrics_report"))
    report = record.first().asDict(recursive=True)
    # 3: statistical EDA on the featured base
    write_report(S.categorical_association(featured, EDA_CATEGORICAL), out("eda_categorical_association"))
    write_report(S.numeric_significance(featured, EDA_NUMERIC), out("eda_numeric_significance"))
    # 4-5: evaluation curve on test, importance
    write_report(TH.profit_curve(test, econ), out("profit_curve"))
    limit = fit_premium_threshold(data.where(F.col("split") == "train"))
    test_rows = data.where(F.col("split") == "test").withColumn("is_premium", premium_flag(F.col("MonthlyCharges"), limit))
    write_report(X.permutation_importance(model, test_rows, NUMERIC + CATEGORICAL), out("feature_importance"))
    # 6: survival
    write_report(SV.median_survival(featured, "Contract"), out("median_survival_by_contract"))
    write_report(SV.km_table(featured, group="Contract"), out("survival_curves_by_contract"))
    write_report(SV.cox_ph(featured), out("cox_hazard_ratios"))
    # 7-10: full base scored by the calibrated model (includes training rows, as in the original)
    scored = materialize(with_value_at_risk(model.transform(model_input), econ))
    write_report(top_value_at_risk(scored, 200, econ), out("top_value_at_risk"))
    strategy = strategy_matrix(kmeans_segments(scored)).cache()
    write_report(strategy, out("retention_strategy_matrix"))
    uplift = U.uplift_targeting(scored, 0.2)
    write_report(select_present(top_k(uplift, U.uplift_order(), 200), [
        "customerID", "churn_probability", "responsiveness", "uplift_score", "persuadable_category", "target"]),
        out("uplift_targets"))
    assigned = PO.assign_actions(scored, econ)
    summary = PO.policy_summary(assigned, econ).cache()
    write_report(summary, out("intervention_policy_summary"))
    write_report(select_present(top_k(assigned, [F.col("churn_probability").desc(), F.col("customerID")], 200), [
        "customerID", "Contract", "MonthlyCharges", "churn_probability", "clv", "recommended_action",
        "expected_value_of_action"]), out("intervention_recommendations"))
    n_pers = uplift.where(F.col("persuadable_category") == U.CATEGORIES[0]).count()
    executive = executive_summary(best, report, scored, summary, strategy.count(), n_pers, econ)
    write_dict(spark, executive, out("executive_summary"))
    return executive


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--data", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--quick", action="store_true", help="small forests and few rounds")
    a = ap.parse_args()
    spark = SparkSession.builder.getOrCreate()
    params = ModelParams(rf_trees=50, gbt_rounds=50) if a.quick else ModelParams()
    print(run_reports(spark, a.data, a.out, params))


if __name__ == "__main__":
    main()
