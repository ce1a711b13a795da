"""Kaplan-Meier curves, median survival and a Cox proportional-hazards fit.

Kaplan-Meier: rows are first aggregated to one row per (group, time) with
at-risk entries and events; the at-risk set is a reverse running sum and the
survival a running product over that small table (partitioned by group).

Cox PH: every Newton iteration aggregates, per distinct duration, the sums of
w, w*x, w*x*x' (all rows and event rows) with w = exp(x'b); the risk-set sums
are descending prefix sums over the durations, and the Efron terms of tied
events are sums in closed form, one row per duration, so only the gradient and
the p x p Hessian reach the driver, whatever the number of distinct durations or
ties.  Ties: Efron.  Covariates are standardised and a ridge
penalty 0.5 * n * penalizer * |b|^2 is applied on that scale; coefficients are
mapped back to the original units.
"""
from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwise.functions.distributions import norm_two_sided

COX_COVARIATES = ["MonthlyCharges", "is_month_to_month", "is_autopay", "num_services",
                  "SeniorCitizen", "is_premium", "has_family"]


def km_table(df: DataFrame, duration: str = "tenure", event: str = "Churn",
             group: str | None = None, include_zero: bool = False) -> DataFrame:
    """See ``_km_table``; ``include_zero`` adds a (0, S=1) row where time 0 is not observed."""
    km = _km_table(df, duration, event, group)
    if not include_zero:
        return km
    keys = [group] if group else []
    starts = km.groupBy(*keys).agg(F.min("timeline").alias("_first"), F.max("n_at_risk").alias("_n"))
    zero = starts.where(F.col("_first") > 0).select(
        *keys, F.lit(0.0).alias("timeline"), F.col("_n").alias("n_at_risk"),
        F.lit(0).cast("long").alias("n_events"), F.lit(1.0).alias("survival"))
    return km.unionByName(zero)


def _km_table(df: DataFrame, duration: str, event: str, group: str | None) -> DataFrame:
    """(group?, timeline, n_at_risk, n_events, survival) at every observed time.

    Rows are aggregated to one row per (group, time), sorted and written once; at-risk
    counts (all of the group less those who left before) and S = exp(sum log(1 - d/n)),
    exactly 0 once an at-risk set is exhausted, are running sums over its buckets.
    Rows without a group or duration are left out.
    """
    from keepwise.operators.metrics import ordered, running_sums

    keys = [group] if group else []
    per_t = df.na.drop(subset=[*keys, duration]).groupBy(*keys, F.col(duration).cast("double").alias("timeline")).agg(
        F.count(F.lit(1)).alias("n_t"), F.sum(F.col(event).cast("long")).alias("n_events"))
    work = ordered(per_t, "timeline", keys)
    sizes = work.groupBy(*keys).agg(F.sum("n_t").alias("_all"))
    gone = running_sums(work, ["n_t"], by=keys)
    if keys:
        gone = gone.join(sizes, keys)                     # one row per group
    else:
        gone = gone.withColumn("_all", F.lit(sizes.first()["_all"]).cast("long"))
    risk = gone.withColumn("n_at_risk", F.col("_all") - F.col("n_t_cum") + F.col("n_t"))
    exhausted = F.col("n_events") >= F.col("n_at_risk")
    terms = (risk.withColumn("_log", F.when(exhausted, F.lit(0.0))
                             .otherwise(F.log1p(-F.col("n_events") / F.col("n_at_risk"))))
                 .withColumn("_zero", F.when(exhausted, 1).otherwise(0).cast("long")))
    run = running_sums(terms, ["_log", "_zero"], by=keys)
    surv = F.when(F.col("_zero_cum") > 0, F.lit(0.0)).otherwise(F.exp(F.col("_log_cum")))
    return run.select(*keys, "timeline", "n_at_risk", "n_events", surv.alias("survival"))


def median_survival(df: DataFrame, group: str, duration: str = "tenure",
                    event: str = "Churn") -> DataFrame:
    """First time with S <= 0.5 (infinity if never), size and event rate per group."""
    km = km_table(df, duration, event, group)
    med = km.groupBy(group).agg(
        F.coalesce(F.min(F.when(F.col("survival") <= 0.5, F.col("timeline"))),
                   F.lit(float("inf"))).alias("median_survival_months"))
    size = df.na.drop(subset=[group, duration]).groupBy(group).agg(F.count(F.lit(1)).alias("n_customers"),
                                 F.avg(event).alias("churn_rate"))
    return (med.join(size, group).select(group, "median_survival_months", "n_customers", "churn_rate")
               .orderBy("median_survival_months", group))


_DIRECT = 12


def _tie_sums(a: Column, d: Column) -> tuple[Column, Column, Column]:
    """Sums of log y, 1 / y and 1 / y^2 over y = a, a - 1, ..., a - d + 1 (a >= d >= 1), whatever d, in fixed work.

    They are differences of the log-gamma, digamma and trigamma functions: the ``_DIRECT`` smallest
    terms are added one by one, the rest by the Euler-Maclaurin formula, whose differences are
    written so that a much larger than d loses no digits.
    """
    low = a - d + 1
    few = F.sequence(F.lit(0), (F.least(d, F.lit(_DIRECT)) - 1).cast("int"))

    def direct(f):
        return F.aggregate(F.transform(few, lambda j: f(low + j)), F.lit(0.0), lambda s, v: s + v)

    left = low + _DIRECT                                   # smallest of the remaining terms; a is the largest
    gap = a - left
    rest = d > _DIRECT
    log = (gap * (F.log(a) - 1) + left * F.log1p(gap / left) + (F.log(a) + F.log(left)) / 2 + (1 / a - 1 / left) / 12
           - (1 / F.pow(a, F.lit(3)) - 1 / F.pow(left, F.lit(3))) / 360 + (1 / F.pow(a, F.lit(5)) - 1 / F.pow(left, F.lit(5))) / 1260)
    one = (F.log1p(gap / left) + (1 / a + 1 / left) / 2 - (1 / F.pow(a, F.lit(2)) - 1 / F.pow(left, F.lit(2))) / 12
           + (1 / F.pow(a, F.lit(4)) - 1 / F.pow(left, F.lit(4))) / 120 - (1 / F.pow(a, F.lit(6)) - 1 / F.pow(left, F.lit(6))) / 252)
    two = (gap / (a * left) + (1 / F.pow(a, F.lit(2)) + 1 / F.pow(left, F.lit(2))) / 2 - (1 / F.pow(a, F.lit(3)) - 1 / F.pow(left, F.lit(3))) / 6
           + (1 / F.pow(a, F.lit(5)) - 1 / F.pow(left, F.lit(5))) / 30 - (1 / F.pow(a, F.lit(7)) - 1 / F.pow(left, F.lit(7))) / 42)
    return tuple(direct(f) + F.when(rest, g).otherwise(F.lit(0.0))
                 for f, g in ((F.log, log), (lambda y: 1 / y, one), (lambda y: 1 / (y * y), two)))


def _efron_pass(z: DataFrame, beta: np.ndarray, p: int, pairs: list) -> tuple:
    """Efron log-likelihood, gradient and Hessian at ``beta``, all sums in Spark.

    1. one row per distinct duration: sums of w, w*z, w*z*z' (all rows, event rows);
    2. risk-set sums = descending inclusive running sums over durations (bucketed);
    3. the Efron terms of d tied events in closed form (``_tie_sums``), one row per duration
       however many ties it has; one final aggregation returns p + p(p+1)/2 + 1 numbers.

    With W, E the risk set's and the events' sums of w, the l-th tied term's weight is
    W - l E / d = (E / d) (a - l) for a = W d / E.
    """
    from keepwise.operators.metrics import prefix_sums

    xb = sum((F.col(f"z{i}") * F.lit(float(beta[i])) for i in range(p)), F.lit(0.0))
    w = F.exp(xb)
    ev = F.col("_e") == 1
    aggs = [F.sum(w).alias("w"), F.count_if(ev).alias("d"),
            F.coalesce(F.sum(F.when(ev, w)), F.lit(0.0)).alias("ew"),
            F.coalesce(F.sum(F.when(ev, xb)), F.lit(0.0)).alias("exb")]
    for i in range(p):
        zi = F.col(f"z{i}")
        aggs += [F.sum(w * zi).alias(f"wx{i}"), F.coalesce(F.sum(F.when(ev, w * zi)), F.lit(0.0)).alias(f"ewx{i}"),
                 F.coalesce(F.sum(F.when(ev, zi)), F.lit(0.0)).alias(f"ex{i}")]
    for i, j in pairs:
        zz = F.col(f"z{i}") * F.col(f"z{j}")
        aggs += [F.sum(w * zz).alias(f"wxx{i}_{j}"),
                 F.coalesce(F.sum(F.when(ev, w * zz)), F.lit(0.0)).alias(f"ewxx{i}_{j}")]
    per_t = z.groupBy("_t").agg(*aggs)
    risk_cols = ["w", *[f"wx{i}" for i in range(p)], *[f"wxx{i}_{j}" for i, j in pairs]]
    risk = prefix_sums(per_t, "_t", risk_cols, descending=True)
    d, ew = F.col("d").cast("double"), F.col("ew")
    whole = F.greatest(F.col("w_cum"), ew)                 # equal when all at risk have the event: no rounding below it
    logs, ones, twos = _tie_sums(whole * d / ew, d)
    keep = [c for c in risk.columns if c not in risk_cols]
    ties = risk.where(F.col("d") > 0).select(*keep, logs.alias("_s0"), ones.alias("_s1"), twos.alias("_s2"), (whole / ew).alias("_q"), (d / ew).alias("_r"))
    u = [F.col(f"wx{i}_cum") - F.col("_q") * F.col(f"ewx{i}") for i in range(p)]
    v = [F.col(f"ewx{i}") / ew for i in range(p)]
    s1, s2, r = F.col("_s1"), F.col("_s2"), F.col("_r")
    terms = [F.sum(F.col("exb") - F.col("_s0") + d * F.log(r)).alias("ll")]
    terms += [F.sum(F.col(f"ex{i}") - r * u[i] * s1 - d * v[i]).alias(f"g{i}") for i in range(p)]
    for i, j in pairs:
        second = r * (F.col(f"wxx{i}_{j}_cum") - F.col("_q") * F.col(f"ewxx{i}_{j}")) * s1 + d * F.col(f"ewxx{i}_{j}") / ew
        square = r * r * u[i] * u[j] * s2 + r * (u[i] * v[j] + u[j] * v[i]) * s1 + d * v[i] * v[j]
        terms.append(F.sum(square - second).alias(f"h{i}_{j}"))
    t = ties.agg(*terms).first()
    ll = float(t["ll"] or 0.0)
    g = np.array([float(t[f"g{i}"] or 0.0) for i in range(p)])
    h = np.zeros((p, p))
    for i, j in pairs:
        h[i, j] = h[j, i] = float(t[f"h{i}_{j}"] or 0.0)
    return ll, g, h


def cox_ph(df: DataFrame, covariates: Sequence[str] = COX_COVARIATES, duration: str = "tenure",
           event: str = "Churn", penalizer: float = 0.1, min_duration: float = 0.5,
           max_iter: int = 50, tol: float = 1e-9) -> DataFrame:
    """Penalised Cox model: feature, coef, hazard_ratio, p_value (by hazard ratio desc).

    Newton steps are halved while the penalised likelihood falls.  A fit that does
    not converge, or has no event, gives an empty table with a warning.
    """
    spark = df.sparkSession
    cov = [c for c in covariates if c in df.columns]
    p = len(cov)
    base = df.select(F.greatest(F.col(duration).cast("double"), F.lit(min_duration)).alias("_t"),
                     F.col(event).cast("double").alias("_e"),
                     *[F.col(c).cast("double").alias(c) for c in cov]).na.drop()
    mom = base.agg(F.count(F.lit(1)).alias("n"),
                   *[F.avg(c).alias(f"m_{c}") for c in cov],
                   *[F.stddev_samp(c).alias(f"s_{c}") for c in cov]).first()
    n = int(mom["n"])
    mean = np.array([mom[f"m_{c}"] or 0.0 for c in cov])
    std = np.array([mom[f"s_{c}"] or 1.0 for c in cov])
    std[std == 0] = 1.0
    z = base.select("_t", "_e", *[((F.col(c) - F.lit(float(mean[i]))) / F.lit(float(std[i]))).alias(f"z{i}")
                                  for i, c in enumerate(cov)]).persist(StorageLevel.MEMORY_AND_DISK)
    beta = np.zeros(p)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    nothing = spark.createDataFrame([], "feature string, coef double, hazard_ratio double, p_value double")

    def at(b: np.ndarray) -> tuple:
        ll, g, h = _efron_pass(z, b, p, pairs)
        return ll - 0.5 * n * penalizer * float(b @ b), g - n * penalizer * b, h - n * penalizer * np.eye(p)

    try:
        if not n or not p or z.where("_e = 1").isEmpty():
            warnings.warn("Cox fit without covariates, rows or events")
            return nothing
        ll, g, h = at(beta)
        converged = False
        for _ in range(max_iter):
            step = np.linalg.solve(h, g)
            if not np.isfinite(step).all():
                break
            new = at(beta - step)
            while not (new[0] >= ll - 1e-9 * abs(ll)) and np.max(np.abs(step)) >= tol:
                step = step / 2
                new = at(beta - step)
            beta, (ll, g, h) = beta - step, new
            if np.max(np.abs(step)) < tol:
                converged = True
                break
        cov_norm = np.linalg.inv(-h) if converged else None
    except np.linalg.LinAlgError:
        converged = False
    finally:
        z.unpersist()
    if not converged or not (np.diag(cov_norm) > 0).all():
        warnings.warn("Cox fit did not converge")
        return nothing
    coef = beta / std
    se = np.sqrt(np.diag(cov_norm)) / std
    rows = [(c, float(coef[i]), float(np.exp(coef[i])), float(norm_two_sided(coef[i] / se[i])))
            for i, c in enumerate(cov)]
    out = spark.createDataFrame(rows, "feature string, coef double, hazard_ratio double, p_value double")
    return out.orderBy(F.col("hazard_ratio").desc())
