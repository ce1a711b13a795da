"""Independent SQL formulations (DuckDB dialect) of the checkable operators.

Every statement is the shared ``sb_*`` CTE chain (fixture -> clean -> features
-> value) followed by one query.  The SQL is written from the operator
definitions, not generated from the Spark plans, so the two sides check each
other.  Float constants are injected as exact ``CAST('<repr>' AS DOUBLE)``.
"""
from __future__ import annotations

from keepwise.config import CONTRACT_HORIZON, DEFAULT_HORIZON, Economics

ECON = Economics()


def d(x: float) -> str:
    """Exact double literal."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


_F12 = d(ECON.annuity_factor(CONTRACT_HORIZON["Month-to-month"]))
_F24 = d(ECON.annuity_factor(CONTRACT_HORIZON["One year"]))
_F48 = d(ECON.annuity_factor(CONTRACT_HORIZON["Two year"]))
_FDEF = d(ECON.annuity_factor(DEFAULT_HORIZON))
_MARGIN = d(ECON.margin_fraction)

CLV_SQL = (f"MonthlyCharges * {_MARGIN} * CASE WHEN Contract = 'Month-to-month' THEN {_F12} "
           f"WHEN Contract = 'One year' THEN {_F24} WHEN Contract = 'Two year' THEN {_F48} "
           f"ELSE {_FDEF} END")

_SERVICES = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
             "StreamingTV", "StreamingMovies"]

_addon_cols = ",\n    ".join(
    f"MAX(CASE WHEN l_linenumber = {k} THEN 1 ELSE 0 END) AS a{k}" for k in range(1, 7))
_service_cols = ",\n    ".join(
    f"CASE WHEN InternetService = 'No' THEN 'No internet service' "
    f"WHEN a{i + 1} = 1 THEN 'Yes' ELSE 'No' END AS {c}" for i, c in enumerate(_SERVICES))

BASE_CTES = f"""
sb_li AS (
  SELECT l_orderkey,
    {_addon_cols}
  FROM lineitem GROUP BY l_orderkey
),
sb_j AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
    c.c_custkey, c.c_nationkey,
    COALESCE(li.a1, 0) AS a1, COALESCE(li.a2, 0) AS a2, COALESCE(li.a3, 0) AS a3,
    COALESCE(li.a4, 0) AS a4, COALESCE(li.a5, 0) AS a5, COALESCE(li.a6, 0) AS a6,
    CASE WHEN o.o_orderstatus = 'F' THEN 'Fiber optic' WHEN o.o_orderstatus = 'O' THEN 'DSL'
         ELSE 'No' END AS InternetService,
    LEAST(72, CAST(2001 * 12 + 8 - (EXTRACT(YEAR FROM o.o_orderdate) * 12
                                   + EXTRACT(MONTH FROM o.o_orderdate)) AS INT)) AS tenure
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN sb_li li ON o.o_orderkey = li.l_orderkey
),
sb_r0 AS (
  SELECT o_orderkey,
    CAST(o_orderkey AS VARCHAR) AS customerID,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
    tenure,
    CASE WHEN o_orderkey % 10 <> 0 THEN 'Yes' ELSE 'No' END AS PhoneService,
    CASE WHEN o_orderkey % 10 = 0 THEN 'No phone service'
         WHEN o_orderkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    InternetService,
    {_service_cols},
    CASE WHEN SUBSTR(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN 'Month-to-month'
         WHEN SUBSTR(o_orderpriority, 1, 1) = '4' THEN 'One year'
         WHEN SUBSTR(o_orderpriority, 1, 1) = '5' THEN 'Two year' END AS Contract,
    CASE WHEN o_orderkey % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Electronic check' WHEN o_orderkey % 4 = 1 THEN 'Mailed check'
         WHEN o_orderkey % 4 = 2 THEN 'Bank transfer (automatic)'
         ELSE 'Credit card (automatic)' END AS PaymentMethod,
    9.95e0 + CASE WHEN o_orderkey % 10 = 0 THEN 0e0 WHEN o_orderkey % 3 = 0 THEN 19.75e0 ELSE 12.5e0 END
         + CASE InternetService WHEN 'Fiber optic' THEN 39.9e0 WHEN 'DSL' THEN 24.4e0 ELSE 0e0 END
         + CASE WHEN InternetService = 'No' THEN 0e0 ELSE 4.5e0 * (a1 + a2 + a3 + a4 + a5 + a6) END
         + (FLOOR(o_totalprice) % 997) / 100e0 AS MonthlyCharges
  FROM sb_j
),
sb_r1 AS (
  SELECT *,
    CASE WHEN tenure = 0 THEN ' ' ELSE CAST(MonthlyCharges * tenure AS VARCHAR) END AS TotalCharges,
    1e0 / (1e0 + EXP((8e0 - (
        CASE Contract WHEN 'Month-to-month' THEN 3e0 WHEN 'One year' THEN 1e0 ELSE 0e0 END
        + CASE WHEN tenure <= 12 THEN 3e0 WHEN tenure <= 36 THEN 1e0 ELSE 0e0 END
        + CASE InternetService WHEN 'Fiber optic' THEN 2e0 WHEN 'DSL' THEN 1e0 ELSE 0e0 END
        + CASE WHEN TechSupport = 'No' THEN 1e0 ELSE 0e0 END
        + CASE WHEN PaymentMethod LIKE '%check' THEN 1e0 ELSE 0e0 END
        - CASE WHEN 'Yes' IN (Partner, Dependents) THEN 1e0 ELSE 0e0 END
        + MonthlyCharges / 40e0)) / 1.6e0)) AS churn_probability
  FROM sb_r0
),
sb_raw AS (
  SELECT *,
    CASE WHEN (((o_orderkey % 2147483648) * 1103515245 + 12345) % 2147483648) / 2147483648e0
              < churn_probability THEN 'Yes' ELSE 'No' END AS Churn
  FROM sb_r1
),
sb_clean AS (
  SELECT o_orderkey, customerID, gender, CAST(SeniorCitizen AS INT) AS SeniorCitizen, Partner,
    Dependents, tenure, PhoneService, MultipleLines, InternetService, OnlineSecurity, OnlineBackup,
    DeviceProtection, TechSupport, StreamingTV, StreamingMovies, Contract, PaperlessBilling,
    PaymentMethod, MonthlyCharges,
    COALESCE(TRY_CAST(TRIM(TotalCharges) AS DOUBLE), 0e0) AS TotalCharges,
    churn_probability,
    CASE WHEN LOWER(TRIM(Churn)) = 'yes' THEN 1 ELSE 0 END AS Churn
  FROM sb_raw
  QUALIFY ROW_NUMBER() OVER (PARTITION BY customerID ORDER BY o_orderkey) = 1
),
sb_p75 AS (
  SELECT QUANTILE_CONT(MonthlyCharges, 0.75) AS thr FROM sb_clean
),
sb_feat AS (
  SELECT s.*,
    CASE WHEN tenure <= 6 THEN '0-6m' WHEN tenure <= 12 THEN '6-12m' WHEN tenure <= 24 THEN '1-2y'
         WHEN tenure <= 48 THEN '2-4y' WHEN tenure IS NOT NULL THEN '4y+' END AS tenure_group,
    (CASE WHEN OnlineSecurity = 'Yes' THEN 1 ELSE 0 END + CASE WHEN OnlineBackup = 'Yes' THEN 1 ELSE 0 END
     + CASE WHEN DeviceProtection = 'Yes' THEN 1 ELSE 0 END + CASE WHEN TechSupport = 'Yes' THEN 1 ELSE 0 END
     + CASE WHEN StreamingTV = 'Yes' THEN 1 ELSE 0 END
     + CASE WHEN StreamingMovies = 'Yes' THEN 1 ELSE 0 END) AS num_services,
    TotalCharges / CASE WHEN tenure = 0 THEN 1 ELSE tenure END AS avg_charges_per_tenure,
    MonthlyCharges / (tenure + 1) AS charge_tenure_ratio,
    CASE WHEN MonthlyCharges >= (SELECT thr FROM sb_p75) THEN 1 ELSE 0 END AS is_premium,
    CASE WHEN COALESCE(LOWER(PaymentMethod) LIKE '%automatic%', FALSE) THEN 1 ELSE 0 END AS is_autopay,
    CASE WHEN Contract = 'Month-to-month' THEN 1 ELSE 0 END AS is_month_to_month,
    CASE WHEN Partner = 'Yes' OR Dependents = 'Yes' THEN 1 ELSE 0 END AS has_family
  FROM sb_clean s
),
sb AS (
  SELECT *, CASE WHEN num_services > 0 THEN 1 ELSE 0 END AS has_addon_service,
    {CLV_SQL} AS clv,
    churn_probability * ({CLV_SQL}) AS expected_value_at_risk
  FROM sb_feat
)"""


def with_base(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the shared CTE chain (plus optional further CTEs)."""
    ctes = BASE_CTES + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"
