"""Helpers that several operators share: tables, text measures, saved tables, hot-safe joins."""
from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwise.session import scratch_path, ship_package

# fixed value: the white space that separates words (as a Java / DuckDB character class body)
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH_BYTES = 2 << 20


def table_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text string) of ``docs`` on their way to Python workers, in Arrow batches of bounded bytes.

    The bound is Spark's own setting, lowered in this session where it is larger: ten thousand whole texts,
    the default size of a batch, may be more than a worker holds."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(re.match(r"-?\d+", conf.get(key))[0]) <= _BATCH_BYTES:
        conf.set(key, str(_BATCH_BYTES))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and return the written table."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted(df: DataFrame, by: str | list[str], salts: int) -> DataFrame:
    by = [by] if isinstance(by, str) else by
    return df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)))


def per_key(rows: DataFrame, key: list[str], partial: list[Column], final: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Aggregate salted ``rows`` by ``key`` in two steps.

    Returns (one row per key, one row per (key, _salt) that occurs). A key that
    holds a third of all rows meets in one task only as its salts' partial rows.
    """
    part = rows.groupBy(*key, "_salt").agg(*partial)
    return part.groupBy(*key).agg(*final), part.select(*key, "_salt")


def fan_out(rows: DataFrame, pairs: DataFrame, facts: DataFrame, key: list[str]) -> DataFrame:
    """Bring per-key ``facts`` back to the salted ``rows`` by (key, _salt), so no task gets a whole hot key."""
    return rows.join(pairs.join(facts, key), [*key, "_salt"], "left").drop("_salt")
