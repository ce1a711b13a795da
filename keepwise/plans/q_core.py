"""Cleaning, features, lifetime value and value-at-risk queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from keepwise.operators.clean import cleaning_audit, dedup_by_key, lenient_double
from keepwise.operators.value import (top_value_at_risk, value_at_risk,
                                      value_at_risk_summary)
from keepwise.plans.base import (cleaned_base, featured_base, premium_threshold, raw_base,
                                 scored_base)
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import with_base


@register("raw_scan", with_base("""
SELECT customerID, gender, SeniorCitizen, Partner, Dependents, tenure, PhoneService, MultipleLines,
  InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport, StreamingTV,
  StreamingMovies, Contract, PaperlessBilling, PaymentMethod, ROUND(MonthlyCharges, 6) AS MonthlyCharges,
  TotalCharges = ' ' AS blank_total, Churn
FROM sb_raw"""))
def q_raw_scan(spark, sf):
    r = raw_base(spark, sf)
    cols = [c for c in r.columns if c not in ("o_orderkey", "churn_probability", "TotalCharges",
                                              "MonthlyCharges", "Churn")]
    return r.select(*cols, r6("MonthlyCharges").alias("MonthlyCharges"),
                    (F.col("TotalCharges") == " ").alias("blank_total"), "Churn")


@register("clean_total_charges", with_base("""
SELECT customerID, tenure, TotalCharges,
  TRY_CAST(TRIM(r.TotalCharges_raw) AS DOUBLE) IS NULL AS was_unparseable
FROM (SELECT customerID, tenure, ROUND(COALESCE(TRY_CAST(TRIM(TotalCharges) AS DOUBLE), 0e0), 6) AS TotalCharges,
        TotalCharges AS TotalCharges_raw FROM sb_raw) r"""))
def q_clean_total_charges(spark, sf):
    r = raw_base(spark, sf)
    parsed = lenient_double("TotalCharges")
    return r.select("customerID", "tenure",
                    F.round(F.coalesce(parsed, F.lit(0.0)), 6).alias("TotalCharges"),
                    parsed.isNull().alias("was_unparseable"))


@register("cleaning_audit", with_base("""
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
  CAST(COUNT(*) FILTER (WHERE TRY_CAST(TRIM(TotalCharges) AS DOUBLE) IS NULL) AS BIGINT) AS n_unparseable_total,
  CAST(COUNT(*) FILTER (WHERE TRY_CAST(TRIM(TotalCharges) AS DOUBLE) IS NULL AND tenure > 0) AS BIGINT)
    AS n_unparseable_with_tenure,
  CAST(COUNT(*) - COUNT(DISTINCT customerID) AS BIGINT) AS n_duplicate_ids,
  CAST(COUNT(*) FILTER (WHERE LOWER(TRIM(Churn)) = 'yes') AS BIGINT) AS n_label_yes
FROM sb_raw"""))
def q_cleaning_audit(spark, sf):
    return cleaning_audit(raw_base(spark, sf))


@register("clean_label", with_base("""
SELECT customerID, Churn, SeniorCitizen FROM sb_clean"""))
def q_clean_label(spark, sf):
    return cleaned_base(spark, sf).select("customerID", "Churn", "SeniorCitizen")


@register("dedup_by_key", with_base("""
SELECT customerID, tenure, ROUND(MonthlyCharges, 6) AS MonthlyCharges, Contract
FROM (SELECT * FROM sb_raw UNION ALL SELECT * FROM sb_raw)
QUALIFY ROW_NUMBER() OVER (PARTITION BY customerID ORDER BY o_orderkey) = 1"""))
def q_dedup_by_key(spark, sf):
    r = raw_base(spark, sf)
    doubled = r.unionByName(r)          # every key twice: dedup must restore the table
    return (dedup_by_key(doubled, "customerID", "o_orderkey")
            .select("customerID", "tenure", r6("MonthlyCharges").alias("MonthlyCharges"), "Contract"))


@register("tenure_group", with_base("""
SELECT customerID, tenure, tenure_group FROM sb"""))
def q_tenure_group(spark, sf):
    return featured_base(spark, sf).select("customerID", "tenure", "tenure_group")


@register("num_services", with_base("""
SELECT customerID, num_services, has_addon_service FROM sb"""))
def q_num_services(spark, sf):
    return featured_base(spark, sf).select("customerID", "num_services", "has_addon_service")


@register("engineered_features", with_base("""
SELECT customerID, tenure_group, num_services, has_addon_service,
  ROUND(avg_charges_per_tenure, 6) AS avg_charges_per_tenure,
  ROUND(charge_tenure_ratio, 6) AS charge_tenure_ratio,
  is_premium, is_autopay, is_month_to_month, has_family
FROM sb"""))
def q_engineered_features(spark, sf):
    f = featured_base(spark, sf)
    return f.select("customerID", "tenure_group", "num_services", "has_addon_service",
                    r6("avg_charges_per_tenure").alias("avg_charges_per_tenure"),
                    r6("charge_tenure_ratio").alias("charge_tenure_ratio"),
                    "is_premium", "is_autopay", "is_month_to_month", "has_family")


@register("premium_flag", with_base("""
SELECT ROUND((SELECT thr FROM sb_p75), 6) AS premium_threshold,
  CAST(SUM(is_premium) AS BIGINT) AS n_premium, CAST(COUNT(*) AS BIGINT) AS n_customers
FROM sb"""))
def q_premium_flag(spark, sf):
    thr = premium_threshold(spark, sf)
    return (featured_base(spark, sf)
            .agg(F.sum("is_premium").cast("long").alias("n_premium"),
                 F.count(F.lit(1)).alias("n_customers"))
            .select(F.round(F.lit(thr), 6).alias("premium_threshold"), "n_premium", "n_customers"))


@register("clv", with_base("""
SELECT customerID, Contract, MonthlyCharges, ROUND(clv, 6) AS clv FROM sb"""))
def q_clv(spark, sf):
    return scored_base(spark, sf).select("customerID", "Contract", "MonthlyCharges", r6("clv").alias("clv"))


_VAR_COLS = """customerID, Contract, ROUND(MonthlyCharges, 6) AS MonthlyCharges, tenure,
  ROUND(churn_probability, 6) AS churn_probability, ROUND(clv, 6) AS clv,
  ROUND(expected_value_at_risk, 6) AS expected_value_at_risk"""


def _var_out(df):
    return df.select("customerID", "Contract", r6("MonthlyCharges").alias("MonthlyCharges"), "tenure",
                     r6("churn_probability").alias("churn_probability"), r6("clv").alias("clv"),
                     r6("expected_value_at_risk").alias("expected_value_at_risk"), "priority_rank")


@register("value_at_risk_top", with_base(f"""
SELECT {_VAR_COLS}, priority_rank FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY expected_value_at_risk DESC, customerID) AS BIGINT)
    AS priority_rank FROM sb) t
WHERE priority_rank <= 200"""))
def q_value_at_risk_top(spark, sf):
    return _var_out(top_value_at_risk(featured_base(spark, sf), 200))


@register("value_at_risk_ranked", with_base(f"""
SELECT {_VAR_COLS}, CAST(ROW_NUMBER() OVER (ORDER BY expected_value_at_risk DESC, customerID) AS BIGINT)
  AS priority_rank FROM sb"""))
def q_value_at_risk_ranked(spark, sf):
    # project before ranking: the ranked table is checkpointed, so pruning must happen first
    f = featured_base(spark, sf).select("customerID", "Contract", "MonthlyCharges", "tenure", "churn_probability")
    return _var_out(value_at_risk(f))


@register("top_decile_share", with_base("""
SELECT CAST(COUNT(*) AS BIGINT) AS n_customers,
  CAST(GREATEST(1, COUNT(*) // 10) AS BIGINT) AS top_decile_size,
  ROUND(SUM(expected_value_at_risk), 4) AS total_value_at_risk,
  ROUND(SUM(expected_value_at_risk) FILTER (WHERE rk <= GREATEST(1, n // 10)), 4) AS top_decile_value_at_risk,
  ROUND(SUM(expected_value_at_risk) FILTER (WHERE rk <= GREATEST(1, n // 10))
        / SUM(expected_value_at_risk), 6) AS top_decile_share
FROM (SELECT expected_value_at_risk, ROW_NUMBER() OVER (ORDER BY expected_value_at_risk DESC) AS rk,
        COUNT(*) OVER () AS n FROM sb) t"""))
def q_top_decile_share(spark, sf):
    s = value_at_risk_summary(scored_base(spark, sf))
    return s.select("n_customers", "top_decile_size",
                    r6("total_value_at_risk", 4).alias("total_value_at_risk"),
                    r6("top_decile_value_at_risk", 4).alias("top_decile_value_at_risk"),
                    r6("top_decile_share").alias("top_decile_share"))
