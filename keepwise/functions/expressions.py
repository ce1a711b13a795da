"""Small column-expression helpers (all JVM-side, codegen-friendly)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk tiers are right-closed bins (-0.01, 0.3] (0.3, 0.6] (0.6, 1.01]
# labelled Low, Medium, High.
RISK_TIER_EDGES = (-0.01, 0.3, 0.6, 1.01)
RISK_TIER_LABELS = ("Low", "Medium", "High")


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi)))


def risk_tier(p: Column) -> Column:
    """Right-closed probability bins to Low / Medium / High (NULL outside the edges)."""
    e, lab = RISK_TIER_EDGES, RISK_TIER_LABELS
    return (F.when((p > e[0]) & (p <= e[1]), F.lit(lab[0]))
             .when((p > e[1]) & (p <= e[2]), F.lit(lab[1]))
             .when((p > e[2]) & (p <= e[3]), F.lit(lab[2])))


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)
