"""Writers for processed tables, report tables and JSON summaries.

Large tables are written partitioned as produced; only report tables whose
size is bounded by construction (top-k lists, per-feature or per-segment
tables) are coalesced into one file for people to open.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from keepwise.config import DEFAULT, Settings
from keepwise.operators.clean import clean_data


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> str:
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    getattr(w, fmt)(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    """A bounded report table as one header CSV file (no index column)."""
    return write_table(df, path, fmt="csv", single_file=True)


def write_record(df: DataFrame, path: str) -> str:
    """A one-row DataFrame (nested structs/arrays allowed) as JSON; any other number of rows is an error."""
    if (n := len(df.take(2))) != 1:
        raise ValueError(f"a record has one row, not {'none' if n == 0 else 'several'}")
    return write_table(df, path, fmt="json", single_file=True)


def write_dict(spark: SparkSession, record: dict, path: str) -> str:
    """A small driver-side summary (scalars already computed by Spark jobs) as JSON."""
    df = spark.createDataFrame([(json.dumps(record, default=float),)], "record string")
    return write_table(df, path, fmt="text", single_file=True)


def build_processed_dataset(raw: DataFrame, path: str, settings: Settings = DEFAULT) -> DataFrame:
    """Clean the raw table, persist it as Parquet and return the written table."""
    cleaned = clean_data(raw, settings)
    write_table(cleaned, path)
    return raw.sparkSession.read.parquet(path)
