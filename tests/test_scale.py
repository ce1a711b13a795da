"""Steps whose memory or work must not grow with the whole input in one task or result."""
from pyspark.sql import functions as F

from keepwise.operators import quantile
from keepwise.operators.clean import clean_data
from keepwise.operators.stats import quartiles_by_class
from keepwise.sources import subscriber


def _tables(spark, folder, orders):
    key = F.col("id")
    spark.range(20).select(key.alias("c_custkey"), (key % 7).cast("int").alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")
    (spark.range(orders, numPartitions=1)
     .select(key.alias("o_orderkey"), (key % 20).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (key * 1.5).alias("o_totalprice"),
             F.lit("1998-03-01").cast("date").alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority"))
     .write.parquet(f"{folder}/orders.parquet"))
    (spark.range(2 * orders).select((key % orders).alias("l_orderkey"), F.floor(key / orders).cast("int").alias("l_linenumber"))
     .write.parquet(f"{folder}/lineitem.parquet"))


def test_wide_subscriber_rows_are_dealt_out_by_number(spark, tmp_dir, monkeypatch):
    _tables(spark, tmp_dir, 2000)
    whole = sorted(map(tuple, clean_data(subscriber.subscriber_raw(spark, tmp_dir)).collect()))
    monkeypatch.setattr(subscriber, "_TASK_ROWS", 100, raising=False)
    raw = subscriber.subscriber_raw(spark, tmp_dir)
    most = raw.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 300
    assert sorted(map(tuple, clean_data(raw).collect())) == whole and len(whole) == 2000


def test_quantiles_of_columns_and_classes_do_not_shuffle_their_rows(spark, monkeypatch):
    plans, counted = [], quantile._counted

    def noted(rows, *rest):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return counted(rows, *rest)

    monkeypatch.setattr(quantile, "_counted", noted)
    df = spark.range(1001).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") % 2).alias("Churn"))
    assert quantile.column_quantiles(df, ["a", "b"], [0.5]) == {"a": [500.0], "b": [1000.0]}
    assert {tuple(r) for r in quartiles_by_class(df, ["a"]).collect()} == {("a", 0, 250.0, 500.0, 750.0), ("a", 1, 250.5, 500.0, 749.5)}
    assert len(plans) == 2 and all("strategy=broadcast" in p for p in plans)
