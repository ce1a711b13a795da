"""Uplift, segments, intervention policy, risk tiers, report views and the
executive summary (all on the scorecard probability of the fixture)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from keepwise.config import Economics
from keepwise.functions.expressions import risk_tier
from keepwise.operators import metrics as M
from keepwise.operators import policy as PO
from keepwise.operators import threshold as TH
from keepwise.operators import uplift as U
from keepwise.operators.ranking import top_k
from keepwise.operators.segments import STRATEGY, strategy_matrix
from keepwise.operators.value import value_at_risk_summary
from keepwise.plans.base import featured_base, scored_base
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import d, with_base
from keepwise.plans.q_metrics import _CURVE, _SCORES

ECON = Economics()
MANUAL_BANDS = (0.22, 0.6)      # example fixed bands (low, high)

_UPLIFT = f"""
sb_mm AS (SELECT MIN(MonthlyCharges) AS lo_mc, MAX(MonthlyCharges) AS hi_mc,
            MIN(num_services) AS lo_ns, MAX(num_services) AS hi_ns FROM sb),
sb_u0 AS (
  SELECT s.*, LEAST(GREATEST(0e0 + 0.35e0 * is_month_to_month + 0.25e0 * (1 - is_autopay)
      + 0.25e0 * (MonthlyCharges - (SELECT lo_mc FROM sb_mm))
        / (((SELECT hi_mc FROM sb_mm) - (SELECT lo_mc FROM sb_mm)) + 1e-9)
      + 0.15e0 * (1e0 - (num_services - (SELECT lo_ns FROM sb_mm))
        / (((SELECT hi_ns FROM sb_mm) - (SELECT lo_ns FROM sb_mm)) + 1e-9)), 0e0), 1e0) AS responsiveness
  FROM sb s),
sb_u1 AS (SELECT *, churn_probability * responsiveness AS uplift_score FROM sb_u0),
sb_med AS (SELECT QUANTILE_CONT(churn_probability, 0.5) AS mp, QUANTILE_CONT(responsiveness, 0.5) AS mr FROM sb_u1),
sb_u AS (
  SELECT u.*, CASE WHEN churn_probability >= (SELECT mp FROM sb_med) AND responsiveness >= (SELECT mr FROM sb_med)
                   THEN '{U.CATEGORIES[0]}'
                   WHEN churn_probability >= (SELECT mp FROM sb_med) THEN '{U.CATEGORIES[1].replace("'", "''")}'
                   WHEN responsiveness >= (SELECT mr FROM sb_med) THEN '{U.CATEGORIES[2]}'
                   ELSE '{U.CATEGORIES[3]}' END AS persuadable_category,
    CAST(ROW_NUMBER() OVER (ORDER BY uplift_score DESC, customerID) AS BIGINT) AS uplift_rank,
    CAST(GREATEST(1, FLOOR(COUNT(*) OVER () * 0.2e0)) AS BIGINT) AS n_target
  FROM sb_u1 u)"""


UPLIFT_INPUTS = ["customerID", "churn_probability", "MonthlyCharges", "num_services", "is_month_to_month",
                 "is_autopay"]


def _uplift(spark, sf):
    # project before ranking: the ranked table is checkpointed, so pruning must happen first
    return U.uplift_targeting(featured_base(spark, sf).select(*UPLIFT_INPUTS), 0.2)


@register("responsiveness", with_base("SELECT customerID, ROUND(responsiveness, 6) AS responsiveness FROM sb_u0",
                                      _UPLIFT))
def q_responsiveness(spark, sf):
    return U.responsiveness(featured_base(spark, sf)).select("customerID", r6("responsiveness").alias("responsiveness"))


@register("uplift_quadrants", with_base("""
SELECT customerID, ROUND(churn_probability, 6) AS churn_probability, ROUND(responsiveness, 6) AS responsiveness,
  ROUND(uplift_score, 6) AS uplift_score, persuadable_category FROM sb_u""", _UPLIFT))
def q_uplift_quadrants(spark, sf):
    u = U.uplift_scores(featured_base(spark, sf))
    return u.select("customerID", r6("churn_probability").alias("churn_probability"),
                    r6("responsiveness").alias("responsiveness"), r6("uplift_score").alias("uplift_score"),
                    "persuadable_category")


@register("uplift_budget", with_base("""
SELECT customerID, ROUND(uplift_score, 6) AS uplift_score, uplift_rank, uplift_rank <= n_target AS target
FROM sb_u""", _UPLIFT))
def q_uplift_budget(spark, sf):
    return _uplift(spark, sf).select("customerID", r6("uplift_score").alias("uplift_score"), "uplift_rank", "target")


@register("uplift_targets_top", with_base("""
SELECT customerID, ROUND(churn_probability, 6) AS churn_probability, ROUND(responsiveness, 6) AS responsiveness,
  ROUND(uplift_score, 6) AS uplift_score, persuadable_category, uplift_rank <= n_target AS target
FROM sb_u WHERE uplift_rank <= 200""", _UPLIFT))
def q_uplift_targets_top(spark, sf):
    f = featured_base(spark, sf)
    u = U.uplift_scores(f)
    n_target = max(1, int(f.count() * 0.2))
    top = top_k(u, U.uplift_order(), 200, rank_col="uplift_rank")
    return top.select("customerID", r6("churn_probability").alias("churn_probability"),
                      r6("responsiveness").alias("responsiveness"), r6("uplift_score").alias("uplift_score"),
                      "persuadable_category", (F.col("uplift_rank") <= n_target).alias("target"))


_STRAT_SQL = "CASE " + " ".join(
    f"WHEN avg_clv {'>=' if v else '<'} vm AND avg_churn_prob {'>=' if r else '<'} rm THEN '{t}'"
    for (v, r), t in STRATEGY.items()) + " END"


@register("strategy_matrix", with_base(f"""
SELECT segment, n_customers, ROUND(avg_tenure, 6) AS avg_tenure, ROUND(avg_monthly_charges, 6) AS avg_monthly_charges,
  ROUND(avg_num_services, 6) AS avg_num_services, ROUND(avg_churn_prob, 6) AS avg_churn_prob,
  ROUND(avg_clv, 6) AS avg_clv, ROUND(actual_churn_rate, 6) AS actual_churn_rate,
  CASE WHEN avg_clv >= vm THEN 'High-value' ELSE 'Low-value' END || ' / ' ||
  CASE WHEN avg_churn_prob >= rm THEN 'High-risk' ELSE 'Low-risk' END AS segment_label,
  {_STRAT_SQL} AS recommended_strategy,
  ROUND(avg_churn_prob * avg_clv * n_customers, 4) AS total_value_at_risk
FROM (SELECT *, (SELECT QUANTILE_CONT(avg_churn_prob, 0.5) FROM sb_seg) AS rm,
        (SELECT QUANTILE_CONT(avg_clv, 0.5) FROM sb_seg) AS vm FROM sb_seg) t""",
    """
sb_seg AS (
  SELECT CAST(o_orderkey % 4 AS INT) AS segment, CAST(COUNT(*) AS BIGINT) AS n_customers, AVG(tenure) AS avg_tenure,
    AVG(MonthlyCharges) AS avg_monthly_charges, AVG(num_services) AS avg_num_services,
    AVG(churn_probability) AS avg_churn_prob, AVG(clv) AS avg_clv, AVG(Churn) AS actual_churn_rate
  FROM sb GROUP BY 1)"""))
def q_strategy_matrix(spark, sf):
    s = scored_base(spark, sf).withColumn("segment", (F.col("o_orderkey") % 4).cast("int"))
    m = strategy_matrix(s)
    return m.select("segment", "n_customers", *[r6(c).alias(c) for c in (
        "avg_tenure", "avg_monthly_charges", "avg_num_services", "avg_churn_prob", "avg_clv", "actual_churn_rate")],
        "segment_label", "recommended_strategy", r6("total_value_at_risk", 4).alias("total_value_at_risk"))


_EVD = f"churn_probability * {d(ECON.discount_success)} * clv - {d(ECON.discount_cost)}"
_EVC = f"churn_probability * {d(ECON.call_success)} * clv - {d(ECON.call_cost)}"
_POLICY = f"""
sb_ev AS (SELECT *, {_EVD} AS ev_d, {_EVC} AS ev_c FROM sb),
sb_act AS (
  SELECT *, CASE WHEN ev_c > 0e0 AND ev_c > ev_d THEN 'call' WHEN ev_d > 0e0 THEN 'discount' ELSE 'do_nothing' END
      AS recommended_action,
    GREATEST(0e0, ev_d, ev_c) AS expected_value_of_action
  FROM sb_ev),
sb_dim AS (SELECT * FROM (VALUES (0, 'do_nothing', 0e0, 0e0), (1, 'discount', {d(ECON.discount_cost)},
             {d(ECON.discount_success)}), (2, 'call', {d(ECON.call_cost)}, {d(ECON.call_success)}))
           t(ord, action, unit_cost, succ)),
sb_pol AS (
  SELECT m.ord, m.action, CAST(COUNT(a.customerID) AS BIGINT) AS n_customers,
    ROUND(COUNT(a.customerID) * m.unit_cost, 2) AS total_cost,
    ROUND(COALESCE(SUM(a.churn_probability * m.succ), 0e0), 1) AS expected_saves,
    ROUND(COALESCE(SUM(a.churn_probability * m.succ * a.clv), 0e0) - COUNT(a.customerID) * m.unit_cost, 2)
      AS expected_value
  FROM sb_dim m LEFT JOIN sb_act a ON a.recommended_action = m.action GROUP BY m.ord, m.action, m.unit_cost)"""


def _assigned(spark, sf):
    return PO.assign_actions(scored_base(spark, sf), ECON)


def _band_sql(v: str) -> str:
    low = (f"LEAST({d(ECON.discount_cost)} / ({d(ECON.discount_success)} * {v}), "
           f"{d(ECON.call_cost)} / ({d(ECON.call_success)} * {v}))")
    up = (f"GREATEST({d(ECON.call_cost - ECON.discount_cost)} / "
          f"({d(ECON.call_success - ECON.discount_success)} * {v}), {low})")
    return (f"LEAST(GREATEST({low}, 0e0), 1e0) AS do_nothing_to_discount, "
            f"LEAST(GREATEST({up}, 0e0), 1e0) AS discount_to_call")


@register("band_boundaries", with_base(f"""
SELECT customerID, ROUND(clv, 6) AS clv, ROUND(do_nothing_to_discount, 6) AS do_nothing_to_discount,
  ROUND(discount_to_call, 6) AS discount_to_call
FROM (SELECT customerID, clv, {_band_sql("clv")} FROM sb) t"""))
def q_band_boundaries(spark, sf):
    s = scored_base(spark, sf).withColumn("b", PO.band_boundaries(F.col("clv"), ECON))
    return s.select("customerID", r6("clv").alias("clv"),
                    r6("b.do_nothing_to_discount").alias("do_nothing_to_discount"),
                    r6("b.discount_to_call").alias("discount_to_call"))


@register("action_assignment", with_base("""
SELECT customerID, ROUND(churn_probability, 6) AS churn_probability, ROUND(clv, 6) AS clv, recommended_action,
  ROUND(expected_value_of_action, 6) AS expected_value_of_action FROM sb_act""", _POLICY))
def q_action_assignment(spark, sf):
    a = _assigned(spark, sf)
    return a.select("customerID", r6("churn_probability").alias("churn_probability"), r6("clv").alias("clv"),
                    "recommended_action", r6("expected_value_of_action").alias("expected_value_of_action"))


@register("action_manual_bands", with_base(f"""
SELECT customerID, ROUND(churn_probability, 6) AS churn_probability,
  CASE WHEN churn_probability < {d(MANUAL_BANDS[0])} THEN 'do_nothing'
       WHEN churn_probability < {d(MANUAL_BANDS[1])} THEN 'discount' ELSE 'call' END AS recommended_action
FROM sb"""))
def q_action_manual_bands(spark, sf):
    a = PO.assign_actions(scored_base(spark, sf), ECON, manual_bands=MANUAL_BANDS)
    return a.select("customerID", r6("churn_probability").alias("churn_probability"), "recommended_action")


@register("policy_summary", with_base("""
SELECT action, n_customers, total_cost, expected_saves, expected_value FROM sb_pol""", _POLICY))
def q_policy_summary(spark, sf):
    return PO.policy_summary(_assigned(spark, sf), ECON)


@register("policy_histogram", with_base("""
SELECT CAST(LEAST(29, FLOOR(churn_probability * 30e0)) AS INT) AS bin, recommended_action, CAST(COUNT(*) AS BIGINT) AS n
FROM sb_act GROUP BY 1, 2""", _POLICY))
def q_policy_histogram(spark, sf):
    return PO.policy_histogram(_assigned(spark, sf))


_REC_COLS = """customerID, Contract, ROUND(MonthlyCharges, 6) AS MonthlyCharges,
  ROUND(churn_probability, 6) AS churn_probability, ROUND(clv, 6) AS clv, recommended_action,
  ROUND(expected_value_of_action, 6) AS expected_value_of_action"""


def _recommendations(spark, sf, n=200):
    a = _assigned(spark, sf)
    top = top_k(a, [F.col("churn_probability").desc(), F.col("customerID")], n)
    return top.select("customerID", "Contract", r6("MonthlyCharges").alias("MonthlyCharges"),
                      r6("churn_probability").alias("churn_probability"), r6("clv").alias("clv"),
                      "recommended_action", r6("expected_value_of_action").alias("expected_value_of_action"))


@register("intervention_recommendations", with_base(f"""
SELECT {_REC_COLS} FROM sb_act ORDER BY churn_probability DESC, customerID LIMIT 200""", _POLICY))
def q_intervention_recommendations(spark, sf):
    return _recommendations(spark, sf)


@register("action_plan", with_base(f"""
SELECT * FROM (SELECT {_REC_COLS} FROM sb_act ORDER BY churn_probability DESC, customerID LIMIT 200) r
WHERE recommended_action IN ('call', 'discount')""", _POLICY))
def q_action_plan(spark, sf):
    return _recommendations(spark, sf).where(F.col("recommended_action").isin("call", "discount"))


@register("category_counts", with_base("""
SELECT 'recommended_action' AS kind, recommended_action AS category, CAST(COUNT(*) AS BIGINT) AS n
FROM sb_act GROUP BY 2
UNION ALL
SELECT 'persuadable_category' AS kind, persuadable_category AS category, CAST(COUNT(*) AS BIGINT) AS n
FROM sb_u GROUP BY 2""", _POLICY + "," + _UPLIFT))
def q_category_counts(spark, sf):
    a = _assigned(spark, sf).groupBy(F.col("recommended_action").alias("category")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("recommended_action"))
    u = U.uplift_scores(featured_base(spark, sf)).groupBy(F.col("persuadable_category").alias("category")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("persuadable_category"))
    return a.unionByName(u).select("kind", "category", "n")


def _best_threshold(spark, sf) -> float:
    return TH.optimize_threshold(featured_base(spark, sf), ECON).first()["best_threshold"]


_TIER_SQL = ("CASE WHEN churn_probability > -0.01e0 AND churn_probability <= 0.3e0 THEN 'Low' "
             "WHEN churn_probability > 0.3e0 AND churn_probability <= 0.6e0 THEN 'Medium' "
             "WHEN churn_probability > 0.6e0 AND churn_probability <= 1.01e0 THEN 'High' END")


@register("risk_tiers", with_base(f"""
SELECT customerID, ROUND(churn_probability, 6) AS churn_probability,
  CASE WHEN churn_probability >= (SELECT t FROM sb_pp ORDER BY profit DESC, i LIMIT 1) THEN 1 ELSE 0 END AS risk_flag,
  {_TIER_SQL} AS risk_tier
FROM sb""", _CURVE))
def q_risk_tiers(spark, sf):
    t = _best_threshold(spark, sf)
    f = featured_base(spark, sf)
    return f.select("customerID", r6("churn_probability").alias("churn_probability"),
                    F.when(F.col("churn_probability") >= F.lit(t), 1).otherwise(0).alias("risk_flag"),
                    risk_tier(F.col("churn_probability")).alias("risk_tier"))


@register("slider_bounds", with_base("""
SELECT MIN(MonthlyCharges) AS min_monthly_charges, MAX(MonthlyCharges) AS max_monthly_charges FROM sb"""))
def q_slider_bounds(spark, sf):
    return featured_base(spark, sf).agg(F.min("MonthlyCharges").alias("min_monthly_charges"),
                                        F.max("MonthlyCharges").alias("max_monthly_charges"))


_SAVE_LIST_SQL = f"""
SELECT customerID, Contract, tenure, ROUND(MonthlyCharges, 6) AS MonthlyCharges,
  ROUND(churn_probability, 6) AS churn_probability, risk_tier
FROM (SELECT *, {_TIER_SQL} AS risk_tier FROM sb) t
WHERE risk_tier IN ('High') AND MonthlyCharges >= (SELECT MIN(MonthlyCharges) FROM sb)"""


def _risk_view(spark, sf):
    """The risk explorer's filtered view at its defaults: high risk, charges from the slider's minimum."""
    f = featured_base(spark, sf)
    lo = f.agg(F.min("MonthlyCharges")).first()[0]
    return (f.withColumn("risk_tier", risk_tier(F.col("churn_probability")))
             .where(F.col("risk_tier").isin("High") & (F.col("MonthlyCharges") >= F.lit(lo))))


def _risk_columns(view):
    return view.select("customerID", "Contract", "tenure", r6("MonthlyCharges").alias("MonthlyCharges"),
                       r6("churn_probability").alias("churn_probability"), "risk_tier")


@register("save_list", with_base(_SAVE_LIST_SQL))
def q_save_list(spark, sf):
    """The whole filtered view, as exported."""
    return _risk_columns(_risk_view(spark, sf))


@register("risk_explorer_top", with_base(_SAVE_LIST_SQL + " ORDER BY t.churn_probability DESC, customerID LIMIT 500"))
def q_risk_explorer_top(spark, sf):
    """The 500 rows shown on screen."""
    return _risk_columns(top_k(_risk_view(spark, sf), [F.col("churn_probability").desc(), F.col("customerID")], 500))


# ---------------------------------------------------------------- summary
def _one(df, *cols):
    return df.select(*cols).withColumn("_k", F.lit(1))


@register("executive_summary", with_base(f"""
SELECT
  (SELECT ROUND(SUM(n_pos * cp * 1e0 / (cp + cn)) / SUM(n_pos), 6) FROM sb_sc) AS pr_auc,
  (SELECT ROUND(SUM(n_neg * (cp - n_pos + n_pos * 0.5e0)) / (SUM(n_pos) * SUM(n_neg) * 1e0), 6) FROM sb_sc) AS roc_auc,
  (SELECT ROUND(COUNT(*) FILTER (WHERE Churn = 1 AND churn_probability >= (SELECT t FROM sb_pp ORDER BY profit DESC, i LIMIT 1))
           * 1e0 / COUNT(*) FILTER (WHERE Churn = 1), 6) FROM sb) AS recall_at_optimal_threshold,
  (SELECT ROUND(t, 6) FROM sb_pp ORDER BY profit DESC, i LIMIT 1) AS optimal_threshold,
  (SELECT ROUND(MAX(profit) - MAX(profit) FILTER (WHERE i = 50), 4) FROM sb_pp) AS profit_uplift_vs_default,
  (SELECT ROUND(SUM(expected_value_at_risk), 4) FROM sb) AS total_expected_value_at_risk,
  (SELECT CAST(COUNT(*) FILTER (WHERE persuadable_category = '{U.CATEGORIES[0]}') AS BIGINT) FROM sb_u) AS n_persuadables,
  (SELECT CAST(COUNT(DISTINCT o_orderkey % 4) AS BIGINT) FROM sb) AS segments,
  (SELECT ROUND(do_nothing_to_discount, 6) FROM (SELECT {_band_sql(d(ECON.customer_value))}) b)
    AS policy_band_do_nothing_to_discount,
  (SELECT ROUND(discount_to_call, 6) FROM (SELECT {_band_sql(d(ECON.customer_value))}) b) AS policy_band_discount_to_call,
  (SELECT n_customers FROM sb_pol WHERE action = 'call') AS policy_n_call,
  (SELECT n_customers FROM sb_pol WHERE action = 'discount') AS policy_n_discount,
  (SELECT n_customers FROM sb_pol WHERE action = 'do_nothing') AS policy_n_do_nothing,
  (SELECT ROUND(SUM(expected_value), 2) FROM sb_pol) AS policy_total_expected_value""",
    _SCORES + "," + _CURVE + "," + _UPLIFT + "," + _POLICY))
def q_executive_summary(spark, sf):
    f = featured_base(spark, sf)
    s = scored_base(spark, sf)
    rank = M.ranking_metrics(f)
    opt = TH.optimize_threshold(f, ECON)
    t = opt.first()["best_threshold"]
    conf = M.confusion_metrics(f, t)
    var = value_at_risk_summary(s)
    up = U.uplift_scores(f).agg(F.count_if(F.col("persuadable_category") == U.CATEGORIES[0])
                                .alias("n_persuadables"))
    seg = s.agg(F.count_distinct(F.col("o_orderkey") % 4).alias("segments"))
    pol = PO.policy_summary(_assigned(spark, sf), ECON)
    polw = pol.agg(*[F.max(F.when(F.col("action") == a, F.col("n_customers"))).alias(f"policy_n_{a}")
                     for a in ("call", "discount", "do_nothing")],
                   F.round(F.sum("expected_value"), 2).alias("policy_total_expected_value"))
    bands = PO.band_boundaries(F.lit(ECON.customer_value), ECON)
    parts = [
        _one(rank, r6("pr_auc").alias("pr_auc"), r6("roc_auc").alias("roc_auc")),
        _one(conf, r6("recall").alias("recall_at_optimal_threshold")),
        _one(opt, r6("best_threshold").alias("optimal_threshold"),
             r6("profit_uplift_vs_default", 4).alias("profit_uplift_vs_default")),
        _one(var, r6("total_value_at_risk", 4).alias("total_expected_value_at_risk")),
        _one(up, "n_persuadables"), _one(seg, "segments"),
        _one(polw.withColumn("b", bands), r6("b.do_nothing_to_discount").alias("policy_band_do_nothing_to_discount"),
             r6("b.discount_to_call").alias("policy_band_discount_to_call"),
             "policy_n_call", "policy_n_discount", "policy_n_do_nothing", "policy_total_expected_value"),
    ]
    # single-row frames joined on a constant key (no cross product)
    return reduce(lambda a, b: a.join(b, "_k"), parts).drop("_k")


@register("segment_size_ratio", with_base("""
SELECT segment, n_customers, ROUND(n_customers * 1e0 / MAX(n_customers) OVER (), 6) AS size_ratio
FROM (SELECT CAST(o_orderkey % 4 AS INT) AS segment, CAST(COUNT(*) AS BIGINT) AS n_customers FROM sb GROUP BY 1) t"""))
def q_segment_size_ratio(spark, sf):
    """Segment size relative to the largest segment (k rows: the global window is bounded)."""
    from pyspark.sql import Window
    seg = (featured_base(spark, sf).groupBy((F.col("o_orderkey") % 4).cast("int").alias("segment"))
           .agg(F.count(F.lit(1)).alias("n_customers")))
    return seg.select("segment", "n_customers",
                      r6(F.col("n_customers") / F.max("n_customers").over(Window.partitionBy())).alias("size_ratio"))


@register("explanation_sample", with_base("""
SELECT customerID, tenure, ROUND(MonthlyCharges, 6) AS MonthlyCharges, Contract, InternetService,
  PaymentMethod, num_services FROM sb ORDER BY customerID LIMIT 300"""))
def q_explanation_sample(spark, sf):
    """The fixed 300-row sample used for local explanations (first 300 by id)."""
    f = featured_base(spark, sf)
    return top_k(f, [F.col("customerID")], 300).select(
        "customerID", "tenure", r6("MonthlyCharges").alias("MonthlyCharges"), "Contract", "InternetService",
        "PaymentMethod", "num_services")
