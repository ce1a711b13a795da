"""Statistical EDA queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from keepwise.operators import stats as S
from keepwise.plans.base import featured_base
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import with_base
from keepwise.plans.q_profile import CATEGORICAL, NUMERIC, sql_long

CORR_COLS = NUMERIC + ["Churn"]
DIST_COLS = ["tenure", "MonthlyCharges", "TotalCharges"]


def _long_num(cols):
    return "\nUNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, Churn FROM sb" for c in cols)


_CHI_CTES = f"""
sb_ct AS (
  SELECT feature, level, COUNT(*) FILTER (WHERE Churn = 0) AS o0, COUNT(*) FILTER (WHERE Churn = 1) AS o1
  FROM ({sql_long(CATEGORICAL)}) t GROUP BY feature, level),
sb_ct2 AS (
  SELECT *, o0 + o1 AS rs, SUM(o0) OVER (PARTITION BY feature) AS c0, SUM(o1) OVER (PARTITION BY feature) AS c1,
    COUNT(*) OVER (PARTITION BY feature) AS nl
  FROM sb_ct),
sb_ct3 AS (
  SELECT *, c0 + c1 AS nn, rs * c0 * 1e0 / (c0 + c1) AS e0, rs * c1 * 1e0 / (c0 + c1) AS e1 FROM sb_ct2),
sb_chi AS (
  SELECT feature, MAX(nl) AS n_levels, MAX(nn) AS n, MAX(c0) AS c0, MAX(c1) AS c1,
    SUM(POWER(CASE WHEN nl - 1 = 1 THEN GREATEST(ABS(o0 - e0) - 0.5e0, 0e0) ELSE ABS(o0 - e0) END, 2) / e0
      + POWER(CASE WHEN nl - 1 = 1 THEN GREATEST(ABS(o1 - e1) - 0.5e0, 0e0) ELSE ABS(o1 - e1) END, 2) / e1)
      AS chi2
  FROM sb_ct3 GROUP BY feature),
sb_v AS (
  SELECT *, LEAST(2e0 - 1e0 / (n - 1) - 1e0, n_levels - (n_levels - 1) * (n_levels - 1) * 1e0 / (n - 1) - 1e0)
    AS denom
  FROM sb_chi WHERE n_levels >= 2 AND c0 > 0 AND c1 > 0)"""


@register("chi_square", with_base("""
SELECT feature, CAST(n_levels AS BIGINT) AS n_levels, CAST(n_levels - 1 AS BIGINT) AS dof, CAST(n AS BIGINT) AS n,
  ROUND(chi2, 6) AS chi2,
  ROUND(CASE WHEN denom > 0 THEN SQRT(GREATEST(0e0, chi2 / n - (n_levels - 1) * 1e0 / (n - 1)) / denom)
        ELSE 0e0 END, 6) AS cramers_v
FROM sb_v""", _CHI_CTES))
def q_chi_square(spark, sf):
    cs = S.chi_square(featured_base(spark, sf), CATEGORICAL)
    return cs.select("feature", "n_levels", "dof", "n", r6("chi2").alias("chi2"),
                     r6("cramers_v").alias("cramers_v"))


@register("cramers_v_ranking", with_base("""
SELECT feature, ROUND(CASE WHEN denom > 0 THEN SQRT(GREATEST(0e0, chi2 / n - (n_levels - 1) * 1e0 / (n - 1))
                                                     / denom) ELSE 0e0 END, 6) AS cramers_v
FROM sb_v ORDER BY cramers_v DESC, feature LIMIT 8""", _CHI_CTES))
def q_cramers_v_ranking(spark, sf):
    cs = S.chi_square(featured_base(spark, sf), CATEGORICAL)
    return (cs.select("feature", r6("cramers_v").alias("cramers_v"))
              .orderBy(F.col("cramers_v").desc(), "feature").limit(8))


@register("categorical_association")
def q_categorical_association(spark, sf):
    """Full report table incl. p-values (no SQL function for the tail)."""
    return S.categorical_association(featured_base(spark, sf), CATEGORICAL)


_WELCH = f"""
sb_w AS (
  SELECT feature, COUNT(x) FILTER (WHERE Churn = 1) AS n1, COUNT(x) FILTER (WHERE Churn = 0) AS n0,
    AVG(x) FILTER (WHERE Churn = 1) AS m1, AVG(x) FILTER (WHERE Churn = 0) AS m0,
    VAR_SAMP(x) FILTER (WHERE Churn = 1) AS v1, VAR_SAMP(x) FILTER (WHERE Churn = 0) AS v0
  FROM ({_long_num(NUMERIC)}) t GROUP BY feature)"""


@register("welch_t", with_base("""
SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0, ROUND(m1, 6) AS mean_churned,
  ROUND(m0, 6) AS mean_retained,
  ROUND(CASE WHEN v1 / n1 + v0 / n0 > 0 THEN (m1 - m0) / SQRT(v1 / n1 + v0 / n0) END, 6) AS t_stat,
  ROUND(CASE WHEN v1 / n1 + v0 / n0 > 0 THEN POWER(v1 / n1 + v0 / n0, 2)
        / (POWER(v1 / n1, 2) / (n1 - 1) + POWER(v0 / n0, 2) / (n0 - 1)) END, 6) AS df
FROM sb_w WHERE n1 >= 2 AND n0 >= 2""", _WELCH))
def q_welch_t(spark, sf):
    w = S.welch_t(featured_base(spark, sf), NUMERIC)
    return w.select("feature", "n1", "n0", r6("mean_churned").alias("mean_churned"),
                    r6("mean_retained").alias("mean_retained"), r6("t_stat").alias("t_stat"),
                    r6("df").alias("df"))


@register("cohens_d", with_base("""
SELECT feature, ROUND(CASE WHEN SQRT((v1 + v0) / 2) > 0 THEN (m1 - m0) / SQRT((v1 + v0) / 2) ELSE 0e0 END, 6)
  AS cohens_d, ABS(ROUND(CASE WHEN SQRT((v1 + v0) / 2) > 0 THEN (m1 - m0) / SQRT((v1 + v0) / 2) ELSE 0e0 END, 6)) > 0
  AS nonzero_effect
FROM sb_w WHERE n1 >= 2 AND n0 >= 2""", _WELCH))
def q_cohens_d(spark, sf):
    w = S.welch_t(featured_base(spark, sf), NUMERIC)
    d = r6("cohens_d")
    return w.select("feature", d.alias("cohens_d"), (F.abs(d) > 0).alias("nonzero_effect"))


@register("numeric_significance")
def q_numeric_significance(spark, sf):
    """Full report table incl. Welch p-values."""
    return S.numeric_significance(featured_base(spark, sf), NUMERIC)


_CORR_PAIRS = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]
_CORR_CTE = "sb_corr AS (SELECT " + ", ".join(
    f"CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c{i}" for i, (a, b) in enumerate(_CORR_PAIRS)) + " FROM sb)"


@register("correlation_matrix", with_base("\nUNION ALL ".join(
    [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(c{i}, 6) AS corr FROM sb_corr"
     for i, (a, b) in enumerate(_CORR_PAIRS)]
    + [f"SELECT '{b}' AS feature_a, '{a}' AS feature_b, ROUND(c{i}, 6) AS corr FROM sb_corr"
       for i, (a, b) in enumerate(_CORR_PAIRS)]
    + [f"SELECT '{c}' AS feature_a, '{c}' AS feature_b, 1e0 AS corr" for c in CORR_COLS]), _CORR_CTE))
def q_correlation_matrix(spark, sf):
    c = S.correlation_long(featured_base(spark, sf), CORR_COLS)
    return c.select("feature_a", "feature_b", r6("corr").alias("corr"))


@register("top_target_correlations", with_base(
    "SELECT feature, corr FROM (" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(CORR(CAST({c} AS DOUBLE), CAST(Churn AS DOUBLE)), 6) AS corr FROM sb"
        for c in NUMERIC) + ") t ORDER BY ABS(corr) DESC, feature LIMIT 10"))
def q_top_target_correlations(spark, sf):
    t = S.top_target_correlations(featured_base(spark, sf), NUMERIC)
    return t.select("feature", r6("corr").alias("corr"))


@register("leakage_guard", with_base("SELECT feature, abs_corr, abs_corr >= 0.999e0 AS leaks FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(ABS(CORR(COALESCE(CAST({c} AS DOUBLE), 0e0), CAST(Churn AS DOUBLE))), 6)"
    f" AS abs_corr FROM sb" for c in NUMERIC) + ") t"))
def q_leakage_guard(spark, sf):
    g = S.leakage_guard(featured_base(spark, sf), NUMERIC)
    return g.select("feature", r6("abs_corr").alias("abs_corr"), "leaks")


@register("histogram_by_class", with_base("""
SELECT h.feature, h.Churn,
  CAST(CASE WHEN r.hi - r.lo > 0 THEN LEAST(29, FLOOR((h.x - r.lo) / (r.hi - r.lo) * 30e0)) ELSE 0 END AS INT) AS bin,
  CAST(COUNT(*) AS BIGINT) AS n
FROM sb_h h JOIN sb_hr r ON h.feature = r.feature
GROUP BY 1, 2, 3""", f"""
sb_h AS (SELECT * FROM ({_long_num(DIST_COLS)}) t WHERE x IS NOT NULL),
sb_hr AS (SELECT feature, MIN(x) AS lo, MAX(x) AS hi FROM sb_h GROUP BY feature)"""))
def q_histogram_by_class(spark, sf):
    return S.histogram_by_class(featured_base(spark, sf), DIST_COLS)


@register("quartiles_by_class", with_base(f"""
SELECT feature, Churn, ROUND(QUANTILE_CONT(x, 0.25), 6) AS q25, ROUND(QUANTILE_CONT(x, 0.5), 6) AS q50,
  ROUND(QUANTILE_CONT(x, 0.75), 6) AS q75
FROM ({_long_num(DIST_COLS)}) t WHERE x IS NOT NULL GROUP BY feature, Churn"""))
def q_quartiles_by_class(spark, sf):
    q = S.quartiles_by_class(featured_base(spark, sf), DIST_COLS)
    return q.select("feature", "Churn", r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"))


@register("effect_direction", with_base("""
SELECT feature, CASE WHEN m1 > m0 THEN 'higher_for_churners' WHEN m1 < m0 THEN 'lower_for_churners'
  ELSE 'no_difference' END AS direction
FROM sb_w WHERE n1 >= 2 AND n0 >= 2""", _WELCH))
def q_effect_direction(spark, sf):
    """Sign of the effect (Cohen's d > 0: higher for churners)."""
    w = S.welch_t(featured_base(spark, sf), NUMERIC)
    diff = F.col("mean_churned") - F.col("mean_retained")
    return w.select("feature", F.when(diff > 0, "higher_for_churners").when(diff < 0, "lower_for_churners")
                    .otherwise("no_difference").alias("direction"))
