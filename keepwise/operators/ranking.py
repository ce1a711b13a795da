"""Global ordering operators that never pull all rows into one task.

``row_number() OVER (ORDER BY ...)`` without a partition runs in a single
task.  ``global_rank`` instead range-partitions with a distributed sort,
numbers rows inside each partition with ``monotonically_increasing_id``
(partition id in the upper 31 bits, position in the lower 33), and adds a
per-partition offset from a table with one row per partition.  The sorted
frame is checkpointed first so the counts and the numbering see the same
partition assignment even if executors are lost and tasks re-run.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwise.operators.quantile import kth_value
from keepwise.session import materialize

_LOW_BITS = (1 << 33) - 1


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Add ``rank_col`` = 1..n following ``order`` (make the order total!)."""
    numbered = materialize(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), 33)
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the offset window is tiny by construction
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = numbered.join(F.broadcast(offsets), pid == offsets["_pid"], "inner")
    out = out.withColumn(rank_col, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))
                                    + F.lit(1)).cast("long"))
    return out.drop("_mid", "_pid", "_off")


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows in ``order`` (TakeOrderedAndProject: per-task top-k, then merge)."""
    top = df.orderBy(*order).limit(k)
    if rank_col:
        # at most k rows: the window is bounded by the feature's own limit
        top = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return top


def sum_of_top(df: DataFrame, col: str, k: int) -> float:
    """Exact sum of the ``k`` largest values of ``col`` (ties resolved by value).

    Finds the k-th largest value by distributed selection, then one pass sums
    everything above it plus the right number of copies of it.
    """
    n = df.where(F.col(col).isNotNull()).count()
    if n == 0 or k <= 0:
        return 0.0
    k = min(k, n)
    v = kth_value(df, col, n - k, n)
    row = df.agg(F.sum(F.when(F.col(col) > v, F.col(col))).alias("s"),
                 F.count_if(F.col(col) > v).alias("c")).first()
    return float(row["s"] or 0.0) + (k - row["c"]) * v
