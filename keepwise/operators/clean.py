"""Deterministic cleaning: lenient numeric cast, null fill, label map, dedup."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwise.config import DEFAULT, Settings


def lenient_double(col: str) -> F.Column:
    """Text -> double; unparseable (blank, junk) -> NULL instead of an error."""
    return F.expr(f"try_cast(trim(`{col}`) AS DOUBLE)")


def clean_data(df: DataFrame, settings: Settings = DEFAULT,
               order_col: str | None = "o_orderkey") -> DataFrame:
    """Fix dtypes, fill the blank totals with 0, map the label to 0/1, dedup by id.

    ``order_col`` fixes which duplicate survives ("keep first"); without it the
    full row order is used as tiebreak so the choice does not depend on file order.
    """
    target, id_col = settings.target_col, settings.id_col
    out = df
    if "TotalCharges" in out.columns:
        out = out.withColumn("TotalCharges",
                             F.coalesce(lenient_double("TotalCharges"), F.lit(0.0)))
    if target in out.columns and isinstance(out.schema[target].dataType, T.StringType):
        out = out.withColumn(target, F.when(F.lower(F.trim(F.col(target))) == "yes", 1)
                             .otherwise(0))
    if "SeniorCitizen" in out.columns:
        out = out.withColumn("SeniorCitizen", F.col("SeniorCitizen").cast("int"))
    return dedup_by_key(out, id_col, order_col)


def dedup_by_key(df: DataFrame, id_col: str, order_col: str | None = None) -> DataFrame:
    """Keep the first row per key (smallest ``order_col``, then the rest of the row).

    Written as ``min(struct(order, row))`` per key: a partial (map-side)
    aggregate, so a key duplicated millions of times collapses before the
    shuffle instead of landing whole in one task.
    """
    if id_col not in df.columns:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c != id_col]
    lead = [order_col] if order_col and order_col in rest else []
    tail = [c for c in rest if c not in lead]
    packed = F.struct(*[F.col(c).alias(c) for c in lead + tail])
    kept = df.groupBy(id_col).agg(F.min(packed).alias("_row"))
    return kept.select(*[F.col(id_col) if c == id_col else F.col(f"_row.{c}").alias(c)
                         for c in df.columns])


def cleaning_audit(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One-row audit: rows, unparseable totals (and how many have tenure > 0),
    duplicate keys, label mapping counts."""
    tc = lenient_double("TotalCharges")
    target = settings.target_col
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(tc.isNull()).alias("n_unparseable_total"),
        F.count_if(tc.isNull() & (F.col("tenure") > 0)).alias("n_unparseable_with_tenure"),
        (F.count(F.lit(1)) - F.count_distinct(settings.id_col)).alias("n_duplicate_ids"),
        F.count_if(F.lower(F.trim(F.col(target))) == "yes").alias("n_label_yes"),
    )
