"""The ``subscriber_base`` fixture: one subscription per order.

The driver's test tables are TPC-H-like and hold no churn table, so a
subscriber row is derived per order from ``orders`` ⋈ ``customer`` ⟕
(``lineitem`` aggregated per order).  The rules are documented in FIXTURES.md
and mirrored by the oracle SQL in ``keepwise.plans.oracle``.

Scale notes: the lineitem side is pre-aggregated per ``l_orderkey`` (partial
aggregation before the shuffle), so its output is already hash-partitioned on
the join key and the orders join reuses that partitioning.  The customer side
carries two integer columns only; Spark broadcasts it when its measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise uses a
sort-merge join whose skewed partitions AQE splits.  The joined rows are dealt out by
their number before the wide columns are made, so that a task's memory does not
grow with the input.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwise.sources.tables import read_table

SERVICE_COLS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection",
                "TechSupport", "StreamingTV", "StreamingMovies"]

# ---------------------------------------------------------------------------
# Fixture's own score and prices (mirrored by the SQL in plans/oracle.py).
# Points: contract month-to-month 3, one year 1; tenure up to 12 months 3, up to 36 one;
#   fiber 2, DSL 1; internet without tech support 1; payment by check 1; with a
#   partner or dependents -1; monthly charge / 40.
# Probability: logistic of (points - 8) / 1.6; label: a draw from the order key.
# Prices: 9.95 a month; telephone 12.50, a second line 7.25; fiber 39.90, DSL 24.40;
#   4.50 for each add-on; usage of 0 to 9.96 from the order's price.
# Snapshot month for tenure: August 2001; tenure capped at 72 months.
# ---------------------------------------------------------------------------
_LCG_A, _LCG_C, _LCG_M = 1103515245, 12345, 2147483648
_SNAPSHOT_MONTH_INDEX = 2001 * 12 + 8
# Orders that one task widens and sorts: some 600 bytes a row there. Scan splits and shuffled pieces are cut by
# the compressed bytes of narrow columns, of which a few MB hold millions of orders.
_TASK_ROWS = 250_000


def _yes_no(cond: Column) -> Column:
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def _addon_flags(lineitem: DataFrame) -> DataFrame:
    aggs = [F.max(F.when(F.col("l_linenumber") == k, 1).otherwise(0)).alias(f"a{k}")
            for k in range(1, 7)]
    return lineitem.groupBy("l_orderkey").agg(*aggs)


def risk_points(df: DataFrame) -> Column:
    """The fixture's risk points (column expression)."""
    internet, months = F.col("InternetService"), F.col("tenure")
    contract = F.when(F.col("Contract") == "Month-to-month", 3.0).when(F.col("Contract") == "One year", 1.0).otherwise(0.0)
    age = F.when(months <= 12, 3.0).when(months <= 36, 1.0).otherwise(0.0)
    line = F.when(internet == "Fiber optic", 2.0).when(internet == "DSL", 1.0).otherwise(0.0)
    unaided = F.when(F.col("TechSupport") == "No", 1.0).otherwise(0.0)
    check = F.when(F.col("PaymentMethod").endswith("check"), 1.0).otherwise(0.0)
    family = F.when((F.col("Partner") == "Yes") | (F.col("Dependents") == "Yes"), 1.0).otherwise(0.0)
    return contract + age + line + unaided + check - family + F.col("MonthlyCharges") / F.lit(40.0)


def subscriber_raw(spark: SparkSession, sf_dir: str, with_score: bool = True) -> DataFrame:
    """Raw 21-column customer table (+ ``o_orderkey``, scorecard probability)."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                         "o_orderdate", "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    addons = _addon_flags(read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"]))

    j = (orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
               .join(addons, orders.o_orderkey == addons.l_orderkey, "left"))
    parts = -(-orders.count() // _TASK_ROWS)
    if parts > 1:                              # still narrow: dealt out by rows before the wide columns are made
        j = j.repartition(max(parts, spark.sparkContext.defaultParallelism), "o_orderkey", "o_custkey", "o_totalprice")

    key = F.col("o_orderkey")
    a = [F.coalesce(F.col(f"a{k}"), F.lit(0)) for k in range(1, 7)]
    month_index = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    tenure = F.least(F.lit(72), (F.lit(_SNAPSHOT_MONTH_INDEX) - month_index).cast("int"))
    phone = key % 10 != 0
    internet = (F.when(F.col("o_orderstatus") == "F", F.lit("Fiber optic"))
                 .when(F.col("o_orderstatus") == "O", F.lit("DSL"))
                 .otherwise(F.lit("No")))
    prio = F.substring("o_orderpriority", 1, 1)
    contract = (F.when(prio.isin("1", "2", "3"), F.lit("Month-to-month"))
                 .when(prio == "4", F.lit("One year"))
                 .when(prio == "5", F.lit("Two year")))
    payment = (F.when(key % 4 == 0, F.lit("Electronic check"))
                .when(key % 4 == 1, F.lit("Mailed check"))
                .when(key % 4 == 2, F.lit("Bank transfer (automatic)"))
                .otherwise(F.lit("Credit card (automatic)")))

    base = j.select(
        key.alias("o_orderkey"),
        key.cast("string").alias("customerID"),
        F.when(key % 2 == 0, F.lit("Male")).otherwise(F.lit("Female")).alias("gender"),
        F.when(F.col("c_custkey") % 6 == 0, 1).otherwise(0).alias("SeniorCitizen"),
        _yes_no(F.col("c_nationkey") % 2 == 0).alias("Partner"),
        _yes_no(F.col("c_nationkey") % 3 == 0).alias("Dependents"),
        tenure.alias("tenure"),
        _yes_no(phone).alias("PhoneService"),
        F.when(~phone, F.lit("No phone service"))
         .otherwise(_yes_no(key % 3 == 0)).alias("MultipleLines"),
        internet.alias("InternetService"),
        *[F.when(internet == "No", F.lit("No internet service"))
           .otherwise(_yes_no(a[i] == 1)).alias(c) for i, c in enumerate(SERVICE_COLS)],
        contract.alias("Contract"),
        _yes_no(key % 5 < 3).alias("PaperlessBilling"),
        payment.alias("PaymentMethod"),
        (F.lit(9.95)
         + F.when(~phone, 0.0).when(key % 3 == 0, 19.75).otherwise(12.5)
         + F.when(internet == "Fiber optic", 39.9).when(internet == "DSL", 24.4).otherwise(0.0)
         + F.when(internet == "No", 0.0).otherwise(F.lit(4.5) * (a[0] + a[1] + a[2] + a[3] + a[4] + a[5]))
         + (F.floor("o_totalprice") % 997) / F.lit(100.0)).alias("MonthlyCharges"),
    )
    base = base.withColumn(
        "TotalCharges",
        F.when(F.col("tenure") == 0, F.lit(" "))
         .otherwise((F.col("MonthlyCharges") * F.col("tenure")).cast("string")))
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp((F.lit(8.0) - risk_points(base)) / F.lit(1.6)))
    base = base.withColumn("churn_probability", prob)
    u = ((key % _LCG_M) * _LCG_A + _LCG_C) % _LCG_M / F.lit(float(_LCG_M))
    base = base.withColumn("Churn", F.when(u < F.col("churn_probability"), F.lit("Yes"))
                           .otherwise(F.lit("No")))
    if not with_score:
        base = base.drop("churn_probability")
    return base
