"""Survival queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from keepwise.operators import survival as SV
from keepwise.plans.base import featured_base
from keepwise.plans.catalog import r6, register
from keepwise.plans.oracle import with_base


def _km_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
SELECT {g}timeline, CAST(n_at_risk AS BIGINT) AS n_at_risk, CAST(n_events AS BIGINT) AS n_events,
  ROUND(PRODUCT(1e0 - n_events * 1e0 / n_at_risk) OVER ({part}ORDER BY timeline
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS survival
FROM (SELECT *, SUM(n_t) OVER ({part}ORDER BY timeline DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS n_at_risk
      FROM (SELECT {g}CAST(tenure AS DOUBLE) AS timeline, COUNT(*) AS n_t, SUM(Churn) AS n_events
            FROM sb GROUP BY {g}CAST(tenure AS DOUBLE)) a) b"""


def _km_out(df, group=None):
    keys = [group] if group else []
    return df.select(*keys, "timeline", "n_at_risk", "n_events", r6("survival").alias("survival"))


@register("km_overall", with_base(_km_sql(None)))
def q_km_overall(spark, sf):
    return _km_out(SV.km_table(featured_base(spark, sf)))


@register("km_by_contract", with_base(_km_sql("Contract")))
def q_km_by_contract(spark, sf):
    return _km_out(SV.km_table(featured_base(spark, sf), group="Contract"), "Contract")


@register("median_survival", with_base(f"""
SELECT k.Contract, COALESCE(MIN(k.timeline) FILTER (WHERE k.survival <= 0.5e0), 'Infinity'::DOUBLE)
    AS median_survival_months,
  s.n_customers, s.churn_rate
FROM ({_km_sql("Contract").replace("ROUND(PRODUCT", "(PRODUCT").replace("), 6) AS survival", ")) AS survival")}) k
JOIN (SELECT Contract, CAST(COUNT(*) AS BIGINT) AS n_customers, ROUND(AVG(Churn), 6) AS churn_rate
      FROM sb GROUP BY Contract) s ON k.Contract = s.Contract
GROUP BY k.Contract, s.n_customers, s.churn_rate"""))
def q_median_survival(spark, sf):
    m = SV.median_survival(featured_base(spark, sf), "Contract")
    return m.select("Contract", "median_survival_months", "n_customers", r6("churn_rate").alias("churn_rate"))


@register("cox_hazard_ratios")
def q_cox_hazard_ratios(spark, sf):
    """Penalised Cox PH (iterative Newton; no SQL formulation)."""
    return SV.cox_ph(featured_base(spark, sf))


@register("survival_input", with_base("""
SELECT customerID, GREATEST(CAST(tenure AS DOUBLE), 0.5e0) AS duration, Churn AS event,
  ROUND(MonthlyCharges, 6) AS MonthlyCharges, is_month_to_month, is_autopay, num_services, SeniorCitizen,
  is_premium, has_family
FROM sb"""))
def q_survival_input(spark, sf):
    """Cox input: tenure -> duration clipped below at 0.5, label -> event, the covariates."""
    f = featured_base(spark, sf)
    return (f.withColumnsRenamed({"tenure": "duration", "Churn": "event"})
             .select("customerID", F.greatest(F.col("duration").cast("double"), F.lit(0.5)).alias("duration"),
                     "event", r6("MonthlyCharges").alias("MonthlyCharges"),
                     *[c for c in SV.COX_COVARIATES if c != "MonthlyCharges"]))
