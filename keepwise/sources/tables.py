"""Parquet / CSV scans with explicit column projection.

Reading only the needed columns lets the Parquet scan prune (ReadSchema) and
Catalyst push filters into the reader.
"""
from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Names and types of the raw customer table.
RAW_SCHEMA = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("PhoneService", T.StringType()),
    T.StructField("MultipleLines", T.StringType()),
    T.StructField("InternetService", T.StringType()),
    T.StructField("OnlineSecurity", T.StringType()),
    T.StructField("OnlineBackup", T.StringType()),
    T.StructField("DeviceProtection", T.StringType()),
    T.StructField("TechSupport", T.StringType()),
    T.StructField("StreamingTV", T.StringType()),
    T.StructField("StreamingMovies", T.StringType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaperlessBilling", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.StringType()),   # blanks in raw data
    T.StructField("Churn", T.StringType()),
])

# Required columns (subset check, not full schema).
RAW_COLUMNS = RAW_SCHEMA.fieldNames()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def require_columns(df: DataFrame, required: Iterable[str] = RAW_COLUMNS) -> DataFrame:
    """Schema-subset validation: every required column must be present."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    return df


def read_customer_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw customer export (header CSV) with a fixed schema, no inference."""
    df = spark.read.schema(RAW_SCHEMA).option("header", True).csv(path)
    return require_columns(df)


def select_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Project the wanted report columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])
