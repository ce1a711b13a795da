"""Statistical EDA: chi-square (+Yates), bias-corrected Cramér's V, Welch t,
Cohen's d, Pearson correlations, class-conditional distributions.

Each test is one aggregation over unpivoted data, so all features are tested
in a single pass; only the result tables (one row per feature or level) are
touched by windows and the p-value UDFs.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwise.functions.distributions import chi2_sf_udf, t_two_sided_udf
from keepwise.operators.profile import crosstab_counts
from keepwise.operators.quantile import grouped_quantiles
from keepwise.session import ship_package


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def chi_square(df: DataFrame, cols: Sequence[str], label: str = "Churn") -> DataFrame:
    """chi2, dof, n, levels and Cramér's V per categorical column vs a binary label.

    Yates' continuity correction (|O-E| reduced by at most 0.5) applies when
    dof == 1, as in the classic contingency test; V is computed from the same
    statistic.  Columns with < 2 levels or a missing class are skipped.
    """
    ct = crosstab_counts(df, cols, label)
    totals = ct.groupBy("feature").agg(
        F.sum("n_retained").alias("_c0"), F.sum("n_churned").alias("_c1"), F.count(F.lit(1)).alias("_nl"))
    # (column names are case-insensitive: keep them distinct)
    ct = (ct.join(totals, "feature").withColumn("_rs", F.col("n_retained") + F.col("n_churned"))
            .withColumn("_nn", F.col("_c0") + F.col("_c1")))
    e0 = F.col("_rs") * F.col("_c0") / F.col("_nn")
    e1 = F.col("_rs") * F.col("_c1") / F.col("_nn")
    dof = (F.col("_nl") - 1)

    def term(o: Column, e: Column) -> Column:
        diff = F.abs(o - e)
        adj = F.when(dof == 1, F.greatest(diff - F.lit(0.5), F.lit(0.0))).otherwise(diff)
        return _safe_div(adj * adj, e)

    per = ct.withColumn("_t", term(F.col("n_retained"), e0) + term(F.col("n_churned"), e1))
    agg = (per.groupBy("feature")
              .agg(F.sum("_t").alias("chi2"), F.first("_nn").alias("n"), F.first("_nl").alias("n_levels"),
                   F.first("_c0").alias("_c0"), F.first("_c1").alias("_c1"))
              .where((F.col("n_levels") >= 2) & (F.col("_c0") > 0) & (F.col("_c1") > 0))
              .drop("_c0", "_c1"))
    # bias-corrected V of a two-class label: of the smaller side of the table only 1 - 1/(n - 1) is left
    free, others = F.col("n_levels") - 1, (F.col("n") - 1).cast("double")
    excess = F.greatest(F.col("chi2") / F.col("n") - free / others, F.lit(0.0))
    room = F.least(1 - 1 / others, free * (1 - free / others))
    v = F.when(room > 0, F.sqrt(excess / room)).otherwise(F.lit(0.0))
    return agg.select("feature", F.col("n_levels").cast("long").alias("n_levels"),
                      (F.col("n_levels") - 1).cast("long").alias("dof"),
                      F.col("n").cast("long").alias("n"), "chi2", v.alias("cramers_v"))


def categorical_association(df: DataFrame, cols: Sequence[str], label: str = "Churn") -> DataFrame:
    """The report table: feature, chi2, p_value, cramers_v, significant_5pct (by V desc)."""
    ship_package(df.sparkSession)
    cs = chi_square(df, cols, label)
    p = chi2_sf_udf(F.col("chi2"), F.col("dof").cast("double"))
    return (cs.withColumn("p_value", p)
              .select("feature", "chi2", "p_value", "cramers_v",
                      (F.col("p_value") < 0.05).alias("significant_5pct"))
              .orderBy(F.col("cramers_v").desc(), "feature"))


def welch_t(df: DataFrame, cols: Sequence[str], label: str = "Churn") -> DataFrame:
    """Class means, Welch t and Welch-Satterthwaite df, Cohen's d per numeric column."""
    long = (df.select(F.col(label), *[F.col(c).cast("double").alias(c) for c in cols])
              .unpivot([label], list(cols), "feature", "x"))
    one, zero = F.col(label) == 1, F.col(label) == 0
    x = F.col("x")
    agg = long.groupBy("feature").agg(
        F.count(F.when(one, x)).alias("n1"), F.count(F.when(zero, x)).alias("n0"),
        F.avg(F.when(one, x)).alias("mean_churned"), F.avg(F.when(zero, x)).alias("mean_retained"),
        F.var_samp(F.when(one, x)).alias("v1"), F.var_samp(F.when(zero, x)).alias("v0"))
    agg = agg.where((F.col("n1") >= 2) & (F.col("n0") >= 2))
    s1 = F.col("v1") / F.col("n1")
    s0 = F.col("v0") / F.col("n0")
    se2 = s1 + s0
    diff = F.col("mean_churned") - F.col("mean_retained")
    t = F.when(se2 > 0, diff / F.sqrt(se2))
    dfw = F.when(se2 > 0, se2 * se2 / (s1 * s1 / (F.col("n1") - 1) + s0 * s0 / (F.col("n0") - 1)))
    pooled = F.sqrt((F.col("v1") + F.col("v0")) / 2.0)
    d = F.when(pooled > 0, diff / pooled).otherwise(F.lit(0.0))
    return agg.select("feature", "n1", "n0", "mean_churned", "mean_retained",
                      t.alias("t_stat"), dfw.alias("df"), d.alias("cohens_d"))


def numeric_significance(df: DataFrame, cols: Sequence[str], label: str = "Churn") -> DataFrame:
    """The report table ranked by |Cohen's d|, with two-sided Welch p-values."""
    ship_package(df.sparkSession)
    wt = welch_t(df, cols, label)
    return (wt.withColumn("p_value", t_two_sided_udf(F.abs(F.col("t_stat")), F.col("df")))
              .select("feature", "mean_churned", "mean_retained", "t_stat", "p_value", "cohens_d",
                      (F.col("p_value") < 0.05).alias("significant_5pct"))
              .orderBy(F.abs(F.col("cohens_d")).desc(), "feature"))


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair (long form).

    One distributed pass (``Correlation.corr`` aggregates the Gram matrix);
    only the k x k matrix reaches the driver.  Rows with a NULL in any of the
    columns are left out (complete cases).
    """
    cols = list(cols)
    vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="skip").transform(
        df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    m = Correlation.corr(vec, "_v", "pearson").first()[0].toArray()
    rows = [(a, b, float(m[i, j]) if i != j else 1.0) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def target_correlations(df: DataFrame, cols: Sequence[str], label: str = "Churn",
                        fill_zero: bool = False) -> DataFrame:
    """corr(feature, label) for each column (optionally with NULL -> 0 first)."""
    def val(c):
        x = F.col(c).cast("double")
        return F.coalesce(x, F.lit(0.0)) if fill_zero else x
    wide = df.agg(*[F.corr(val(c), F.col(label).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "feature", "corr")


def top_target_correlations(df: DataFrame, cols: Sequence[str], label: str = "Churn",
                            k: int = 10) -> DataFrame:
    tc = target_correlations(df, [c for c in cols if c != label], label)
    return tc.orderBy(F.abs(F.col("corr")).desc(), "feature").limit(k)


def leakage_guard(df: DataFrame, cols: Sequence[str], label: str = "Churn",
                  limit: float = 0.999) -> DataFrame:
    """|corr(feature.fillna(0), label)| per numeric feature and whether it leaks."""
    tc = target_correlations(df, [c for c in cols if c != label], label, fill_zero=True)
    return tc.select("feature", F.abs(F.col("corr")).alias("abs_corr"),
                     (F.abs(F.col("corr")) >= limit).alias("leaks"))


def histogram_by_class(df: DataFrame, cols: Sequence[str], label: str = "Churn",
                       bins: int = 30) -> DataFrame:
    """Fixed-width histogram (global range per feature) split by class."""
    long = (df.select(F.col(label), *[F.col(c).cast("double").alias(c) for c in cols])
              .unpivot([label], list(cols), "feature", "x").where(F.col("x").isNotNull()))
    rng = long.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    # one row per feature: a bounded broadcast
    j = long.join(F.broadcast(rng), "feature")
    width = F.col("hi") - F.col("lo")
    b = F.when(width > 0, F.least(F.lit(bins - 1),
                                  F.floor((F.col("x") - F.col("lo")) / width * F.lit(float(bins)))
                                  .cast("int"))).otherwise(F.lit(0))
    return j.groupBy("feature", label, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def quartiles_by_class(df: DataFrame, cols: Sequence[str], label: str = "Churn") -> DataFrame:
    long = (df.select(F.col(label), *[F.col(c).cast("double").alias(c) for c in cols])
              .unpivot([label], list(cols), "feature", "x"))
    q = grouped_quantiles(long, "x", [0.25, 0.5, 0.75], ["feature", label], few=True)
    return (q.groupBy("feature", label)
             .pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
             .toDF("feature", label, "q25", "q50", "q75"))
