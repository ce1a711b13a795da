"""Structured Streaming scorer: new raw customer files are scored as they land.

The scorer is row-wise once its statistics are fitted (premium threshold,
pipeline, isotonic maps, decision threshold), so the streaming plan is
stateless: no watermark or state store is needed.  Records are treated as
unlabelled inputs (lenient total cast only), the same path as what-if scoring.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keepwise.models.scoring import ChurnScorer
from keepwise.sources.tables import RAW_SCHEMA

OUTPUT_COLUMNS = ["customerID", "churn_probability", "risk_flag", "risk_tier"]


def scored_stream(spark: SparkSession, scorer: ChurnScorer, source_dir: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(source_dir)
    return scorer.score(raw.drop(scorer.settings.target_col)).select(*OUTPUT_COLUMNS)


def start_scoring(spark: SparkSession, scorer: ChurnScorer, source_dir: str, sink_dir: str,
                  checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """Append scored rows to a Parquet sink; the checkpoint makes restarts exactly-once."""
    stream = scored_stream(spark, scorer, source_dir)
    writer = (stream.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
