"""The operators on data with NULL and NaN: values are blanked by fixed remainders of the order key."""
from __future__ import annotations

from pyspark.sql import functions as F

from keepwise.operators import metrics as M
from keepwise.operators import stats as S
from keepwise.operators import survival as SV
from keepwise.plans.base import featured_base
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import with_base
from keepwise.plans.q_metrics import _SCORES
from keepwise.plans.q_profile import CATEGORICAL, NUMERIC, sql_long
from keepwise.plans.q_stats import _CHI_CTES, _WELCH
from keepwise.plans.q_survival import _km_out, _km_sql

_GAPPY = ["Contract", "gender", "PaymentMethod"]
_AUC = "SELECT ROUND(SUM(n_neg * (cp - n_pos + n_pos * 0.5e0)) / (SUM(n_pos) * SUM(n_neg) * 1e0), 6) AS roc_auc"


def _blank(column: str, every: int):
    return F.when(F.col("o_orderkey") % every != 0, F.col(column))


def _gappy(spark, sf):
    return (featured_base(spark, sf).withColumn("Contract", _blank("Contract", 7))
            .withColumn("gender", _blank("gender", 5)))


_V = ("ROUND(CASE WHEN denom > 0 THEN SQRT(GREATEST(0e0, chi2 / n - (n_levels - 1) * 1e0 / (n - 1)) / denom) "
      "ELSE 0e0 END, 6) AS cramers_v")
_GAPPY_CTES = """
sb_gap AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN Contract END AS Contract,
                    CASE WHEN o_orderkey % 5 <> 0 THEN gender END AS gender) FROM sb),""" + (
    _CHI_CTES.replace(sql_long(CATEGORICAL), sql_long(_GAPPY, "sb_gap"))
             .replace(") t GROUP BY feature, level", ") t WHERE level IS NOT NULL GROUP BY feature, level"))


@register("chi_square_with_nulls", with_base(f"""
SELECT feature, CAST(n_levels AS BIGINT) AS n_levels, CAST(n AS BIGINT) AS n, ROUND(chi2, 6) AS chi2, {_V}
FROM sb_v""", _GAPPY_CTES))
def q_chi_square_with_nulls(spark, sf):
    """Missing values are no level."""
    return S.chi_square(_gappy(spark, sf), _GAPPY).select(
        "feature", "n_levels", "n", r6("chi2").alias("chi2"), r6("cramers_v").alias("cramers_v"))


@register("km_with_null_group", with_base(_km_sql("Contract").replace("FROM sb GROUP", "FROM sb WHERE o_orderkey % 7 <> 0 GROUP")))
def q_km_with_null_group(spark, sf):
    """Rows without a group are in no curve."""
    return _km_out(SV.km_table(_gappy(spark, sf), group="Contract"), "Contract")


@register("roc_auc_with_nulls", with_base(f"{_AUC} FROM sb_sc", _SCORES.replace("FROM sb GROUP", "FROM sb WHERE o_orderkey % 6 <> 0 GROUP")))
def q_roc_auc_with_nulls(spark, sf):
    """NULL scores (every 12th key) and NaN scores (6 beyond) are no part of a ranking."""
    key = F.col("o_orderkey") % 12
    score = F.when(key == 6, F.lit(float("nan"))).when(key != 0, F.col("churn_probability"))
    return M.ranking_metrics(featured_base(spark, sf).withColumn("churn_probability", score)).select(r6("roc_auc").alias("roc_auc"))


@register("quartiles_with_nan", with_base("""
SELECT 'MonthlyCharges' AS feature, Churn, ROUND(QUANTILE_CONT(MonthlyCharges, 0.25), 6) AS q25,
  ROUND(QUANTILE_CONT(MonthlyCharges, 0.5), 6) AS q50, ROUND(QUANTILE_CONT(MonthlyCharges, 0.75), 6) AS q75
FROM sb WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 GROUP BY Churn"""))
def q_quartiles_with_nan(spark, sf):
    key = F.col("o_orderkey")
    charges = F.when(key % 7 == 0, F.lit(float("nan"))).when(key % 5 != 0, F.col("MonthlyCharges"))
    f = featured_base(spark, sf).withColumn("MonthlyCharges", charges)
    return S.quartiles_by_class(f, ["MonthlyCharges"]).select(
        "feature", "Churn", *(r6(c).alias(c) for c in ("q25", "q50", "q75")))


# fixed values: 5 % critical values of chi-square by degrees of freedom, and the normal's two-sided one
CHI_5PCT = {1: 3.841459, 2: 5.991465, 3: 7.814728, 4: 9.487729, 5: 11.070498}
Z_5PCT = 1.959964


@register("association_flags", with_base(f"""
SELECT feature, ROUND(chi2, 6) AS chi2, {_V},
  chi2 > CASE n_levels - 1 {' '.join(f'WHEN {k} THEN {v}e0' for k, v in CHI_5PCT.items())} END AS significant_5pct
FROM sb_v""", _CHI_CTES))
def q_association_flags(spark, sf):
    """The association report without its p-values; SQL judges by critical values."""
    return S.categorical_association(featured_base(spark, sf), CATEGORICAL).select(
        "feature", r6("chi2").alias("chi2"), r6("cramers_v").alias("cramers_v"), "significant_5pct")


@register("numeric_flags", with_base(f"""
SELECT feature, ROUND(t, 6) AS t_stat, ROUND(m1, 6) AS mean_churned, ROUND(m0, 6) AS mean_retained,
  ABS(t) > {Z_5PCT}e0 + (POWER({Z_5PCT}e0, 3) + {Z_5PCT}e0) / (4e0 * df) AS significant_5pct
FROM (SELECT feature, m1, m0, CASE WHEN v1 / n1 + v0 / n0 > 0 THEN (m1 - m0) / SQRT(v1 / n1 + v0 / n0) END AS t,
        CASE WHEN v1 / n1 + v0 / n0 > 0 THEN POWER(v1 / n1 + v0 / n0, 2)
             / (POWER(v1 / n1, 2) / (n1 - 1) + POWER(v0 / n0, 2) / (n0 - 1)) END AS df
      FROM sb_w WHERE n1 >= 2 AND n0 >= 2) w""", _WELCH))
def q_numeric_flags(spark, sf):
    """The Welch report without its p-values; SQL judges by the critical value (first order in 1 / df)."""
    return S.numeric_significance(featured_base(spark, sf), NUMERIC).select(
        "feature", r6("t_stat").alias("t_stat"), r6("mean_churned").alias("mean_churned"),
        r6("mean_retained").alias("mean_retained"), "significant_5pct")
