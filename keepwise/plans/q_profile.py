"""Profiling and churn-rate aggregation queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from keepwise.operators import profile as P
from keepwise.plans.base import featured_base, raw_base
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import with_base
from keepwise.sources.tables import RAW_COLUMNS

CATEGORICAL = ["gender", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService",
               "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
               "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "tenure_group"]
NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "num_services",
           "has_addon_service", "avg_charges_per_tenure", "charge_tenure_ratio", "is_premium",
           "is_autopay", "is_month_to_month", "has_family"]
BANDS = ["0-6", "6-12", "12-24", "24-48", "48-72"]


def sql_long(cols, table="sb", extra="Churn"):
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, {extra} FROM {table}" for c in cols)


SQL_TENURE_BAND = ("CASE WHEN tenure >= 0 AND tenure <= 6 THEN '0-6' WHEN tenure > 6 AND tenure <= 12 "
                   "THEN '6-12' WHEN tenure > 12 AND tenure <= 24 THEN '12-24' WHEN tenure > 24 AND "
                   "tenure <= 48 THEN '24-48' WHEN tenure > 48 AND tenure <= 72 THEN '48-72' END")


@register("class_balance", with_base("""
SELECT Churn, CAST(COUNT(*) AS BIGINT) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share
FROM sb GROUP BY Churn"""))
def q_class_balance(spark, sf):
    return P.class_balance(featured_base(spark, sf)).select("Churn", "n", r6("share").alias("share"))


@register("overall_churn_rate", with_base("""
SELECT ROUND(AVG(Churn), 6) AS churn_rate, CAST(COUNT(DISTINCT Churn) AS BIGINT) AS n_classes FROM sb"""))
def q_overall_churn_rate(spark, sf):
    return featured_base(spark, sf).agg(r6(F.avg("Churn")).alias("churn_rate"),
                                        F.count_distinct("Churn").alias("n_classes"))


@register("churn_rate_by_category", with_base(f"""
SELECT feature, level, CAST(COUNT(*) AS BIGINT) AS n_customers, ROUND(AVG(Churn), 6) AS churn_rate
FROM ({sql_long(CATEGORICAL)}) t GROUP BY feature, level"""))
def q_churn_rate_by_category(spark, sf):
    return (P.churn_rate_by_category(featured_base(spark, sf), CATEGORICAL)
            .select("feature", "level", "n_customers", r6("churn_rate").alias("churn_rate")))


@register("crosstab_counts", with_base(f"""
SELECT feature, level, CAST(COUNT(*) FILTER (WHERE Churn = 0) AS BIGINT) AS n_retained,
  CAST(COUNT(*) FILTER (WHERE Churn = 1) AS BIGINT) AS n_churned
FROM ({sql_long(CATEGORICAL)}) t GROUP BY feature, level"""))
def q_crosstab_counts(spark, sf):
    return P.crosstab_counts(featured_base(spark, sf), CATEGORICAL)


@register("churn_by_tenure_band", with_base(f"""
SELECT {SQL_TENURE_BAND} AS tenure_band, CAST(COUNT(*) AS BIGINT) AS n_customers,
  ROUND(AVG(Churn), 6) AS churn_rate
FROM sb GROUP BY 1"""))
def q_churn_by_tenure_band(spark, sf):
    return (P.churn_by_tenure_band(featured_base(spark, sf))
            .select("tenure_band", "n_customers", r6("churn_rate").alias("churn_rate")))


@register("churn_by_charge_quintile", with_base("""
SELECT CAST(b.bin AS INT) AS bin, ROUND(b.lower_edge, 6) AS lower_edge, ROUND(b.upper_edge, 6) AS upper_edge,
  CAST(COUNT(*) AS BIGINT) AS n_customers, ROUND(AVG(s.Churn), 6) AS churn_rate
FROM sb s JOIN sb_bins b
  ON (s.MonthlyCharges > b.lower_edge OR (b.bin = 1 AND s.MonthlyCharges = b.lower_edge))
 AND s.MonthlyCharges <= b.upper_edge
GROUP BY b.bin, b.lower_edge, b.upper_edge""", """
sb_q AS (SELECT QUANTILE_CONT(MonthlyCharges, [0e0, 0.2e0, 0.4e0, 0.6e0, 0.8e0, 1e0]) AS qs FROM sb),
sb_e AS (SELECT DISTINCT UNNEST(qs) AS e FROM sb_q),
sb_bins AS (
  SELECT * FROM (SELECT e AS upper_edge, LAG(e) OVER (ORDER BY e) AS lower_edge,
                        ROW_NUMBER() OVER (ORDER BY e) - 1 AS bin FROM sb_e) t
  WHERE bin >= 1)"""))
def q_churn_by_charge_quintile(spark, sf):
    return (P.churn_by_quantile_bin(featured_base(spark, sf), "MonthlyCharges", 5)
            .select("bin", r6("lower_edge").alias("lower_edge"), r6("upper_edge").alias("upper_edge"),
                    "n_customers", r6("churn_rate").alias("churn_rate")))


@register("contract_tenure_pivot", with_base(f"""
SELECT Contract, {", ".join(f"ROUND(AVG(Churn) FILTER (WHERE band = '{b}'), 6) AS \"{b}\"" for b in BANDS)}
FROM (SELECT Contract, Churn, {SQL_TENURE_BAND} AS band FROM sb) t GROUP BY Contract"""))
def q_contract_tenure_pivot(spark, sf):
    f = featured_base(spark, sf).withColumn("band", P.tenure_band(F.col("tenure")))
    pv = P.pivot_rate(f, "Contract", "band", BANDS)
    return pv.select("Contract", *[r6(F.col(f"`{b}`")).alias(b) for b in BANDS])


@register("services_rate_count", with_base("""
SELECT num_services, ROUND(AVG(Churn), 6) AS churn_rate, CAST(COUNT(*) AS BIGINT) AS n_customers
FROM sb GROUP BY num_services"""))
def q_services_rate_count(spark, sf):
    return (P.rate_and_count(featured_base(spark, sf), "num_services")
            .select("num_services", r6("churn_rate").alias("churn_rate"), "n_customers"))


@register("missingness_audit", with_base("\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS n_missing, "
    f"ROUND((COUNT(*) - COUNT({c})) * 100e0 / COUNT(*), 2) AS pct_missing FROM sb_raw"
    for c in RAW_COLUMNS)))
def q_missingness_audit(spark, sf):
    return P.missingness(raw_base(spark, sf).select(*RAW_COLUMNS))


@register("duplicate_audit", with_base(f"""
SELECT CAST((SELECT COUNT(*) FROM sb_raw) - (SELECT COUNT(*) FROM (SELECT DISTINCT {", ".join(RAW_COLUMNS)}
        FROM sb_raw) d) AS BIGINT) AS n_duplicate_rows,
  CAST((SELECT COUNT(*) - COUNT(DISTINCT customerID) FROM sb_raw) AS BIGINT) AS n_duplicate_ids"""))
def q_duplicate_audit(spark, sf):
    return P.duplicate_audit(raw_base(spark, sf).select(*RAW_COLUMNS))


@register("describe_numeric", with_base("\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT({c}) AS BIGINT) AS count, ROUND(AVG({c}), 6) AS mean, "
    f"ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min, "
    f"ROUND(QUANTILE_CONT({c}, 0.25), 6) AS q25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS q50, "
    f"ROUND(QUANTILE_CONT({c}, 0.75), 6) AS q75, ROUND(MAX({c}), 6) AS max FROM sb" for c in NUMERIC + ["Churn"])))
def q_describe_numeric(spark, sf):
    d = P.describe_numeric(featured_base(spark, sf), NUMERIC + ["Churn"])
    return d.select("column", "count", *[r6(c).alias(c) for c in
                                          ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@register("describe_categorical", with_base(f"""
SELECT feature AS "column", CAST(SUM(freq) AS BIGINT) AS count, CAST(COUNT(*) AS BIGINT) AS "unique",
  ARG_MIN(level, (-freq, level)) AS top, CAST(MAX(freq) AS BIGINT) AS freq
FROM (SELECT feature, level, COUNT(*) AS freq FROM ({sql_long(["customerID"] + CATEGORICAL, extra="1 AS one")}) t
      WHERE level IS NOT NULL GROUP BY feature, level) g
GROUP BY feature"""))
def q_describe_categorical(spark, sf):
    return P.describe_categorical(featured_base(spark, sf), ["customerID"] + CATEGORICAL)


@register("class_weights", with_base("""
SELECT Churn, CAST(COUNT(*) AS BIGINT) AS n,
  ROUND(SUM(COUNT(*)) OVER () / (2e0 * COUNT(*)), 6) AS class_weight
FROM sb GROUP BY Churn"""))
def q_class_weights(spark, sf):
    cb = P.class_balance(featured_base(spark, sf))
    return cb.select("Churn", "n", r6(F.lit(0.5) / F.col("share")).alias("class_weight"))


@register("imbalance_ratio", with_base("""
SELECT CAST(COUNT(*) FILTER (WHERE Churn = 1) AS BIGINT) AS n_pos,
  CAST(COUNT(*) FILTER (WHERE Churn = 0) AS BIGINT) AS n_neg,
  ROUND(CASE WHEN COUNT(*) FILTER (WHERE Churn = 1) > 0
        THEN COUNT(*) FILTER (WHERE Churn = 0) * 1e0 / COUNT(*) FILTER (WHERE Churn = 1) ELSE 1e0 END, 6)
    AS scale_pos_weight
FROM sb"""))
def q_imbalance_ratio(spark, sf):
    f = featured_base(spark, sf)
    a = f.agg(F.count_if(F.col("Churn") == 1).alias("n_pos"), F.count_if(F.col("Churn") == 0).alias("n_neg"))
    return a.select("n_pos", "n_neg", r6(F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos"))
                                         .otherwise(F.lit(1.0))).alias("scale_pos_weight"))
