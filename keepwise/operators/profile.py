"""Data-quality and churn-rate profiling.

Per-column loops become one pass: the columns are unpivoted into
(feature, level) rows and aggregated with a single ``groupBy`` whose partial
aggregation collapses the rows before the shuffle.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwise.operators.quantile import column_quantiles, exact_quantiles

TENURE_BAND_EDGES = [0, 6, 12, 24, 48, 72]


def unpivot_levels(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Long (keep..., feature, level) rows for the given columns (as text); missing values are no level."""
    wide = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "feature", "level").where(F.col("level").isNotNull())


def class_balance(df: DataFrame, label: str = "Churn") -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # two rows: the global window is bounded by the label domain
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def churn_rate_by_category(df: DataFrame, cols: Sequence[str], label: str = "Churn") -> DataFrame:
    long = unpivot_levels(df, cols, [label])
    return long.groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg(label).alias("churn_rate"))


def crosstab_counts(df: DataFrame, cols: Sequence[str], label: str = "Churn") -> DataFrame:
    """Level x label contingency counts, label values as columns (binary target)."""
    long = unpivot_levels(df, cols, [label])
    return long.groupBy("feature", "level").agg(
        F.count_if(F.col(label) == 0).alias("n_retained"),
        F.count_if(F.col(label) == 1).alias("n_churned"))


def tenure_band(tenure: Column, edges: Sequence[int] = TENURE_BAND_EDGES) -> Column:
    """Right-closed bands over ``edges`` with the lowest edge included."""
    expr = F.when((tenure >= edges[0]) & (tenure <= edges[1]), F.lit(f"{edges[0]}-{edges[1]}"))
    for lo, hi in zip(edges[1:-1], edges[2:]):
        expr = expr.when((tenure > lo) & (tenure <= hi), F.lit(f"{lo}-{hi}"))
    return expr


def churn_by_tenure_band(df: DataFrame, label: str = "Churn") -> DataFrame:
    return (df.withColumn("tenure_band", tenure_band(F.col("tenure")))
              .groupBy("tenure_band")
              .agg(F.count(F.lit(1)).alias("n_customers"), F.avg(label).alias("churn_rate")))


def quantile_edges(df: DataFrame, col: str, q: int = 5) -> list[float]:
    """Equal-frequency edges (exact, interpolated), duplicate edges dropped."""
    edges = exact_quantiles(df, col, [i / q for i in range(q + 1)])
    out: list[float] = []
    for e in edges:
        if not out or e != out[-1]:
            out.append(e)
    return out


def bin_by_edges(x: Column, edges: Sequence[float]) -> Column:
    """1-based right-closed bin over sorted edges, the first bin includes its lower edge."""
    expr = F.when((x >= F.lit(edges[0])) & (x <= F.lit(edges[1])), F.lit(1))
    for i in range(2, len(edges)):
        expr = expr.when((x > F.lit(edges[i - 1])) & (x <= F.lit(edges[i])), F.lit(i))
    return expr


def churn_by_quantile_bin(df: DataFrame, col: str = "MonthlyCharges", q: int = 5,
                          label: str = "Churn") -> DataFrame:
    edges = quantile_edges(df, col, q)
    spark = df.sparkSession
    bounds = spark.createDataFrame([(i, float(edges[i - 1]), float(edges[i]))
                                    for i in range(1, len(edges))],
                                   "bin int, lower_edge double, upper_edge double")
    agg = (df.withColumn("bin", bin_by_edges(F.col(col), edges)).groupBy("bin")
             .agg(F.count(F.lit(1)).alias("n_customers"), F.avg(label).alias("churn_rate")))
    # at most q rows on the right: a bounded broadcast
    return agg.join(F.broadcast(bounds), "bin", "left")


def pivot_rate(df: DataFrame, row: str, col: str, values: Sequence[str],
               label: str = "Churn") -> DataFrame:
    return df.groupBy(row).pivot(col, list(values)).agg(F.avg(label))


def rate_and_count(df: DataFrame, key: str, label: str = "Churn") -> DataFrame:
    return df.groupBy(key).agg(F.avg(label).alias("churn_rate"),
                               F.count(F.lit(1)).alias("n_customers"))


def missingness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage per column, one aggregation pass."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column", "n_missing")
    return long.select("column", "n_missing",
                       F.round(F.col("n_missing") * 100.0 / F.col("_n"), 2).alias("pct_missing"))


def duplicate_audit(df: DataFrame, id_col: str = "customerID") -> DataFrame:
    """Exact duplicate rows (null-safe, via grouping on all columns) and duplicate ids."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    dup_rows = groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows"))
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_c"))
    dup_ids = ids.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("n_duplicate_ids"))
    # two one-row frames: joined on a constant key, not a cross product
    return (dup_rows.withColumn("_k", F.lit(1))
                    .join(dup_ids.withColumn("_k", F.lit(1)), "_k").drop("_k"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles (exact), max per numeric column (long form)."""
    spark = df.sparkSession
    wide = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
        F.stddev_samp(c).alias(f"{c}__std"), F.min(F.col(c).cast("double")).alias(f"{c}__min"),
        F.max(F.col(c).cast("double")).alias(f"{c}__max"))]).first()
    qs = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = []
    for c in cols:
        q25, q50, q75 = qs.get(c, [None, None, None])
        rows.append((c, int(wide[f"{c}__count"]), wide[f"{c}__mean"], wide[f"{c}__std"],
                     wide[f"{c}__min"], q25, q50, q75, wide[f"{c}__max"]))
    return spark.createDataFrame(rows, "column string, count long, mean double, std double, "
                                       "min double, q25 double, q50 double, q75 double, max double")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, unique, top (most frequent, smallest value on ties), freq per text column."""
    long = unpivot_levels(df, cols, []).where(F.col("level").isNotNull())
    per_level = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("freq"))
    return per_level.groupBy("feature").agg(
        F.sum("freq").cast("long").alias("count"),
        F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by("level", F.struct((-F.col("freq")).alias("nf"), F.col("level").alias("lv"))).alias("top"),
        F.max("freq").cast("long").alias("freq")).withColumnRenamed("feature", "column")
