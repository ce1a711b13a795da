"""Exact quantiles (linear interpolation, as ``percentile`` / ``quantile_cont``)
without gathering a column's values anywhere.

Spark's exact ``percentile`` keeps a value->count map that is merged in a
single task for a global (or heavily skewed) group; for continuous columns
that map grows with the data.  Here two scans do for any number of groups and
probabilities:

1. a mergeable quantile sketch per group (``percentile_approx``, rank error at
   most 1 / ``ACCURACY``) brackets every wanted rank from below and above;
2. a counting pass keeps the values inside brackets as they are, snaps every
   other value to the bracket below it, and counts per (group, kept value):
   partial aggregation collapses the rows before the shuffle, and a running
   count over what is left (about 4 / ``ACCURACY`` of the rows a rank) hits
   each rank's exact value.

A rank that its bracket missed lands on a snapped value and is noticed; then
the brackets are widened, in the end to all values, so results are exact
whatever the sketch's error.  State per group stays a DataFrame; without groups
it is one row of scalars.  NULL and NaN have no rank.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwise.session import materialize

ACCURACY = 100_000
_MARGIN = 2.0 / ACCURACY
_WIDER = 64.0


def _values(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    x = F.col(col).cast("double")
    return df.select(*[F.col(c) for c in by], x.alias("_x")).where(x.isNotNull() & ~F.isnan(x))


def _brackets(src: DataFrame, by: list[str], probs: Sequence[float], margin: float, ranks: Sequence[int] | None) -> DataFrame:
    """One row per group: per probability i its bracket _lo, _hi, the two neighbouring ranks _k, _l and the share _f between them."""
    levels = [min(1.0, max(0.0, p + s * margin)) for p in probs for s in (-1, 1)]
    sketch = src.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                  F.percentile_approx("_x", levels, ACCURACY).alias("_at"))
    cols = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(p) if ranks is None else F.lit(float(ranks[i]))
        cols += [(F.col("_min") if levels[2 * i] <= 0.0 else F.col("_at")[2 * i]).alias(f"_lo{i}"),
                 (F.col("_max") if levels[2 * i + 1] >= 1.0 else F.col("_at")[2 * i + 1]).alias(f"_hi{i}"),
                 F.floor(h).alias(f"_k{i}"), F.least(F.col("_n") - 1, F.ceil(h)).alias(f"_l{i}"), (h - F.floor(h)).alias(f"_f{i}")]
    return sketch.where("_n > 0").select(*by, *cols)


def _counted(rows: DataFrame, by: list[str], lo: list[Column], hi: list[Column]) -> DataFrame:
    """by..., _v, _out, _from, _to: kept values (not _out) and snapped ones with the ranks they take."""
    inside = reduce(lambda a, b: a | b, [(F.col("_x") >= a) & (F.col("_x") <= b) for a, b in zip(lo, hi)])
    below = [F.when(b < F.col("_x"), b) for b in hi]
    snapped = F.coalesce(F.greatest(*below) if len(below) > 1 else below[0], F.lit(float("-inf")))
    counts = (rows.select(*by, F.when(inside, F.col("_x")).otherwise(snapped).alias("_v"), (~inside).alias("_out"))
              .groupBy(*by, "_v", "_out").agg(F.count(F.lit(1)).alias("_n")))
    # over the kept values of a group only
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_v", "_out").rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("_n"))


def _scalars(src: DataFrame, probs: list[float], ranks: Sequence[int] | None) -> list[float] | None:
    margin = _MARGIN
    while True:
        at = _brackets(src, [], probs, margin, ranks).first()
        if at is None:
            return None
        n = range(len(probs))
        counted = _counted(src, [], [F.lit(at[f"_lo{i}"]) for i in n], [F.lit(at[f"_hi{i}"]) for i in n])
        wanted = sorted({at[f"_{s}{i}"] for i in n for s in "kl"})
        # at most two rows per probability
        hits = counted.where(reduce(lambda a, b: a | b, [(F.col("_from") <= k) & (F.col("_to") > k) for k in wanted])).collect()
        if not any(r["_out"] for r in hits):
            value = {k: r["_v"] for r in hits for k in wanted if r["_from"] <= k < r["_to"]}
            pairs = [(value[at[f"_k{i}"]], value[at[f"_l{i}"]], at[f"_f{i}"]) for i in n]
            return [a if a == b else a + (b - a) * f for a, b, f in pairs]
        margin *= _WIDER


def grouped_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str], few: bool = False) -> DataFrame:
    """Exact quantiles per group as a long table (by..., q, value); groups without a value are absent.

    ``few``: the groups are known to be few, say columns and classes; their brackets are broadcast. Else the rows meet
    them in a shuffle, a group's rows in one task."""
    by, probs = list(by), [float(p) for p in probs]
    src, n, margin = _values(df, col, by), range(len(probs)), _MARGIN
    keys = [f"_g{i}" for i in range(len(by))]              # names apart: both sides come from the same rows
    src = src.select(*[F.col(c).alias(g) for c, g in zip(by, keys)], "_x")
    same = reduce(lambda a, b: a & b, [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in keys])
    while True:
        at = materialize(_brackets(src, keys, probs, margin, None))
        rows = src.alias("a").join((F.broadcast(at) if few else at).alias("b"), same).select(*[F.col(f"a.{g}").alias(g) for g in keys], "_x", *[f"_{s}{i}" for i in n for s in ("lo", "hi")])
        counted = _counted(rows, keys, [F.col(f"_lo{i}") for i in n], [F.col(f"_hi{i}") for i in n])
        wanted = at.select(*keys, F.explode(F.array(*[F.struct(F.lit(p).alias("q"), F.col(f"_f{i}").alias("_f"), F.col(f"_k{i}").alias("_k"),
                                                               F.col(f"_l{i}").alias("_l")) for i, p in enumerate(probs)])).alias("_w")).select(*keys, "_w.*")
        holds = lambda k: (F.col("_from") <= F.col(k)) & (F.col("_to") > F.col(k))
        met = (counted.alias("a").join(wanted.alias("b"), same & (holds("_k") | holds("_l")))
               .select(*[F.col(f"a.{g}").alias(g) for g in keys], "q", "_f", "_out", F.when(holds("_k"), F.col("_v")).alias("_a"), F.when(holds("_l"), F.col("_v")).alias("_b")))
        found = materialize(met.groupBy(*keys, "q", "_f").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"), F.bool_or("_out").alias("_out")))
        if found.where("_out").isEmpty():
            value = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f"))
            return found.select(*[F.col(g).alias(c) for c, g in zip(by, keys)], "q", value.alias("value"))
        margin *= _WIDER


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float]:
    """Exact linear-interpolated quantiles of ``col`` (one scalar per prob; None without a value)."""
    return _scalars(_values(df, col, []), [float(p) for p in probs], None) or [None for _ in probs]


def kth_value(df: DataFrame, col: str, k: int, n: int) -> float:
    """The value at 0-based rank ``k`` of the ``n`` values of ``col``."""
    return _scalars(_values(df, col, []), [k / max(1, n - 1)], [k])[0]


def ranked_values(df: DataFrame, col: str, ranks: Sequence[int], n: int) -> list[float]:
    """The values at 0-based ``ranks`` of the ``n`` values of ``col``."""
    return _scalars(_values(df, col, []), [k / max(1, n - 1) for k in ranks], list(ranks))


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """Exact quantiles of several columns at once: {column: [value per prob]}; columns without a value are absent."""
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
              .unpivot([], list(cols), "_feature", "_v"))
    out: dict = {}
    # one row per (column, probability)
    for r in grouped_quantiles(long, "_v", sorted(set(probs)), ["_feature"], few=True).collect():
        out.setdefault(r["_feature"], {})[r["q"]] = r["value"]
    return {c: [v[float(p)] for p in probs] for c, v in out.items()}
