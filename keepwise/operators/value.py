"""Customer lifetime value and expected value at risk."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwise.config import CONTRACT_HORIZON, DEFAULT_HORIZON, Economics
from keepwise.operators.quantile import kth_value
from keepwise.operators.ranking import global_rank, top_k

VAR_REPORT_COLUMNS = ["customerID", "Contract", "MonthlyCharges", "tenure",
                      "churn_probability", "clv", "expected_value_at_risk", "priority_rank"]


def clv(econ: Economics = Economics(), contract: str = "Contract",
        charges: str = "MonthlyCharges") -> Column:
    """Present value of the monthly margin over the contract horizon.

    The annuity factor only depends on the horizon, so it is folded into one
    literal per contract type (no per-row ``pow``).
    """
    c = F.col(contract)
    factor = None
    for name, months in CONTRACT_HORIZON.items():
        f = F.lit(econ.annuity_factor(months))
        factor = F.when(c == name, f) if factor is None else factor.when(c == name, f)
    factor = factor.otherwise(F.lit(econ.annuity_factor(DEFAULT_HORIZON)))
    return F.col(charges) * F.lit(econ.margin_fraction) * factor


def with_value_at_risk(df: DataFrame, econ: Economics = Economics(),
                       prob_col: str = "churn_probability") -> DataFrame:
    return (df.withColumn("clv", clv(econ))
              .withColumn("expected_value_at_risk", F.col(prob_col) * F.col("clv")))


def var_order(id_col: str = "customerID") -> list[Column]:
    return [F.col("expected_value_at_risk").desc(), F.col(id_col).asc()]


def value_at_risk(df: DataFrame, econ: Economics = Economics(),
                  prob_col: str = "churn_probability") -> DataFrame:
    """Every customer with clv, expected value at risk and a dense priority rank."""
    return global_rank(with_value_at_risk(df, econ, prob_col), var_order(), "priority_rank")


def top_value_at_risk(df: DataFrame, n: int = 200, econ: Economics = Economics()) -> DataFrame:
    """The n highest-risk customers (report table); rank computed on n rows only."""
    top = top_k(with_value_at_risk(df, econ), var_order(), n, rank_col="priority_rank")
    return top.select(*[c for c in VAR_REPORT_COLUMNS if c in top.columns])


def value_at_risk_summary(df_with_var: DataFrame) -> DataFrame:
    """Total VaR, the top decile's (first max(1, n//10) customers) total and share."""
    col = "expected_value_at_risk"
    n = df_with_var.where(F.col(col).isNotNull()).count()
    k = max(1, n // 10)
    # the k-th largest value is found by distributed selection; the rest is one pass
    v = kth_value(df_with_var, col, max(0, n - k), n) if n else 0.0
    x = F.col(col)
    agg = df_with_var.agg(F.count(F.lit(1)).alias("n_customers"),
                          F.sum(x).alias("total_value_at_risk"),
                          F.coalesce(F.sum(F.when(x > v, x)), F.lit(0.0)).alias("_above"),
                          F.count_if(x > v).alias("_n_above"))
    top = F.col("_above") + (F.lit(k) - F.col("_n_above")) * F.lit(v)
    return agg.select("n_customers", F.lit(k).cast("long").alias("top_decile_size"),
                      "total_value_at_risk", top.alias("top_decile_value_at_risk"),
                      F.when(F.col("total_value_at_risk") != 0, top / F.col("total_value_at_risk"))
                       .otherwise(F.lit(0.0)).alias("top_decile_share"))
