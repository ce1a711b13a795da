"""Business features: all row-wise column expressions except ``is_premium``,
whose 75th-percentile threshold is a fitted statistic.

``fit_premium_threshold`` computes it once (on the training split, or on the
whole frame to reproduce the reference's behaviour) and the threshold is then
applied as a literal, so scoring one row and scoring a billion rows agree.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwise.operators.quantile import exact_quantiles
from keepwise.sources.subscriber import SERVICE_COLS

ENGINEERED_NUMERIC = ["num_services", "has_addon_service", "avg_charges_per_tenure",
                      "charge_tenure_ratio", "is_premium", "is_autopay",
                      "is_month_to_month", "has_family"]
ENGINEERED_CATEGORICAL = ["tenure_group"]
PREMIUM_QUANTILE = 0.75


def tenure_group(tenure: Column) -> Column:
    """Right-closed bins (-1,6] (6,12] (12,24] (24,48] (48,inf); NULL stays NULL."""
    return (F.when(tenure <= 6, F.lit("0-6m"))
             .when(tenure <= 12, F.lit("6-12m"))
             .when(tenure <= 24, F.lit("1-2y"))
             .when(tenure <= 48, F.lit("2-4y"))
             .when(tenure.isNotNull(), F.lit("4y+")))


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def premium_flag(charge: Column, threshold: float | None) -> Column:
    """No threshold (empty input): nobody is premium."""
    return _flag(charge >= F.lit(float(threshold))) if threshold is not None else F.lit(0)


def fit_premium_threshold(df: DataFrame, col: str = "MonthlyCharges") -> float:
    return exact_quantiles(df, col, [PREMIUM_QUANTILE])[0]


def add_engineered_features(df: DataFrame, premium_threshold: float | None = None) -> DataFrame:
    """Return ``df`` with the nine engineered columns.

    ``premium_threshold=None`` uses the frame's own 75th percentile (the
    reference's behaviour, Q1); pass a fitted value for leakage-free use.
    """
    if premium_threshold is None:
        premium_threshold = fit_premium_threshold(df)
    return add_row_features(df).withColumn("is_premium", premium_flag(F.col("MonthlyCharges"), premium_threshold))


def add_row_features(df: DataFrame) -> DataFrame:
    """The eight engineered columns that need no fitted statistic (models fit ``is_premium`` themselves)."""
    cols = set(df.columns)
    services = [c for c in SERVICE_COLS if c in cols]
    num_services = sum((_flag(F.col(c) == "Yes") for c in services), F.lit(0))
    new = {
        "tenure_group": tenure_group(F.col("tenure")),
        "num_services": num_services,
        "has_addon_service": _flag(num_services > 0),
        "avg_charges_per_tenure": F.col("TotalCharges")
        / F.when(F.col("tenure") == 0, F.lit(1)).otherwise(F.col("tenure")),
        "charge_tenure_ratio": F.col("MonthlyCharges") / (F.col("tenure") + F.lit(1)),
    }
    if "PaymentMethod" in cols:
        new["is_autopay"] = _flag(F.coalesce(F.lower(F.col("PaymentMethod"))
                                             .contains("automatic"), F.lit(False)))
    if "Contract" in cols:
        new["is_month_to_month"] = _flag(F.col("Contract") == "Month-to-month")
    if {"Partner", "Dependents"} <= cols:
        new["has_family"] = _flag((F.col("Partner") == "Yes") | (F.col("Dependents") == "Yes"))
    return df.withColumns(new)
