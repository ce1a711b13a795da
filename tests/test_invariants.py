"""Hand-computed micro tables and invariants for the operators."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwise.config import Economics
from keepwise.functions.distributions import chi2_sf, norm_two_sided, t_two_sided
from keepwise.operators import metrics as M
from keepwise.operators import policy as PO
from keepwise.operators import stats as S
from keepwise.operators import survival as SV
from keepwise.operators import threshold as TH
from keepwise.operators.quantile import column_quantiles, exact_quantiles, grouped_quantiles
from keepwise.operators.ranking import global_rank, sum_of_top


def test_pvalue_tails_match_tables():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(2.570581835636314, 5) == pytest.approx(0.05, abs=1e-9)
    assert norm_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-9)


def test_exact_quantiles_equal_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(500, 0.25), rng.integers(0, 5, 700)])
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(vals)], "x double, g int")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, "x", qs)
    assert np.allclose(got, np.quantile(vals, qs), rtol=0, atol=1e-12)
    gq = {(r["g"], r["q"]): r["value"] for r in grouped_quantiles(df, "x", [0.5, 0.75], ["g"]).collect()}
    for g in range(3):
        sub = vals[np.arange(len(vals)) % 3 == g]
        assert gq[(g, 0.5)] == pytest.approx(np.quantile(sub, 0.5), abs=1e-12)
        assert gq[(g, 0.75)] == pytest.approx(np.quantile(sub, 0.75), abs=1e-12)
    cq = column_quantiles(df.withColumn("y", F.col("x") * 2), ["x", "y"], [0.5])
    assert cq["y"][0] == pytest.approx(2 * np.quantile(vals, 0.5), abs=1e-12)


def test_global_rank_is_dense_and_ordered(spark):
    rng = np.random.default_rng(5)
    data = [(i, float(rng.integers(0, 50))) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, v double").repartition(7)
    r = global_rank(df, [F.col("v").desc(), F.col("id")], "rk").toPandas().sort_values("rk")
    assert list(r["rk"]) == list(range(1, 2001))
    expected = sorted(data, key=lambda t: (-t[1], t[0]))
    assert list(r["id"]) == [t[0] for t in expected]
    top = sum_of_top(df, "v", 137)
    assert top == pytest.approx(sum(sorted((t[1] for t in data), reverse=True)[:137]))


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(11)
    keys = rng.permutation(5000).astype(float)
    vals = rng.integers(0, 10, 5000)
    df = spark.createDataFrame([(float(k), int(v), int(k) % 2) for k, v in zip(keys, vals)], "k double, v long, g int")
    out = M.prefix_sums(df, "k", ["v"], descending=True, by=["g"]).toPandas()
    for g in (0, 1):
        sub = out[out.g == g].sort_values("k", ascending=False)
        assert list(sub["v_cum"]) == list(np.cumsum(sub["v"]))


def _brute_ap_auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    order = np.argsort(-p, kind="stable")
    thresholds = np.unique(p)[::-1]
    P, N = y.sum(), (1 - y).sum()
    ap, prev_r = 0.0, 0.0
    for t in thresholds:
        sel = p >= t
        tp = (y[sel] == 1).sum()
        r, prec = tp / P, tp / sel.sum()
        ap += (r - prev_r) * prec
        prev_r = r
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (P * N)
    del order
    return ap, auc


def test_average_precision_and_auc_with_ties(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    p = np.round(np.clip(0.2 * y + rng.normal(0.4, 0.2, 600), 0, 1), 2)   # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "Churn int, churn_probability double")
    r = M.ranking_metrics(df).first()
    ap, auc = _brute_ap_auc(y, p)
    assert r["pr_auc"] == pytest.approx(ap, abs=1e-12)
    assert r["roc_auc"] == pytest.approx(auc, abs=1e-12)
    flipped = M.ranking_metrics(df.withColumn("churn_probability", 1 - F.col("churn_probability"))).first()
    assert flipped["roc_auc"] == pytest.approx(1 - auc, abs=1e-12)


def test_threshold_sweep_equals_naive_and_beats_default(spark):
    rng = np.random.default_rng(77)
    p = np.concatenate([rng.beta(2, 5, 640), [0.0, 0.5, 0.5, 1.0, 0.22, 0.29]])     # grid points and float-unfriendly ones too
    y = (rng.random(len(p)) < p ** 0.7).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "Churn int, churn_probability double")
    econ = Economics()
    curve = TH.profit_curve(df, econ).toPandas().sort_values("threshold")
    grid = np.linspace(0, 1, 101)
    v, c, s = econ.customer_value, econ.retention_offer_cost, econ.offer_success_rate
    naive = [((p >= t) & (y == 1)).sum() * (s * v - c) - ((p >= t) & (y == 0)).sum() * c for t in grid]
    assert np.allclose(curve["profit"].to_numpy(), naive)
    best = TH.optimize_threshold(df, econ).first()
    assert best["best_profit"] >= best["baseline_profit"] - 1e-6
    assert 0.0 <= best["best_threshold"] <= 1.0
    assert best["best_threshold"] == pytest.approx(grid[int(np.argmax(naive))])


def test_business_params():
    e = Economics()
    e.validate()
    assert e.customer_value == pytest.approx(1088.23, abs=0.01)
    assert Economics(annual_discount_rate=0.0).annuity_factor(24) == 24.0


def test_kaplan_meier_with_ties_and_censoring(spark):
    rows = [(1, 1), (1, 0), (2, 1), (2, 1), (3, 0), (4, 1), (4, 0), (5, 0)]
    df = spark.createDataFrame(rows, "tenure int, Churn int")
    km = {r["timeline"]: r["survival"] for r in SV.km_table(df).collect()}
    s1 = 1 - 1 / 8
    s2 = s1 * (1 - 2 / 6)
    s4 = s2 * (1 - 1 / 3)
    assert km[1.0] == pytest.approx(s1)
    assert km[2.0] == pytest.approx(s2)
    assert km[3.0] == pytest.approx(s2)
    assert km[4.0] == pytest.approx(s4)
    assert km[5.0] == pytest.approx(s4)
    vals = [km[t] for t in sorted(km)]
    assert all(a >= b for a, b in zip(vals, vals[1:]))


def test_chi_square_yates_and_cramers_v(spark):
    # 2x2 table: level a -> (retained 20, churned 10); level b -> (retained 10, churned 20)
    rows = [("a", 0)] * 20 + [("a", 1)] * 10 + [("b", 0)] * 10 + [("b", 1)] * 20
    df = spark.createDataFrame(rows, "f string, Churn int")
    r = S.chi_square(df, ["f"]).first()
    obs = np.array([[20, 10], [10, 20]], float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    chi2 = (np.maximum(np.abs(obs - exp) - 0.5, 0) ** 2 / exp).sum()
    assert r["chi2"] == pytest.approx(chi2)
    n = 60
    phi2corr = max(0, chi2 / n - 1 / (n - 1))
    denom = min(2 - 1 / (n - 1) - 1, 2 - 1 / (n - 1) - 1)
    assert r["cramers_v"] == pytest.approx(math.sqrt(phi2corr / denom))
    # 3 levels: no continuity correction
    rows3 = rows + [("c", 0)] * 5 + [("c", 1)] * 15
    r3 = S.chi_square(spark.createDataFrame(rows3, "f string, Churn int"), ["f"]).first()
    obs3 = np.array([[20, 10], [10, 20], [5, 15]], float)
    exp3 = obs3.sum(1, keepdims=True) * obs3.sum(0, keepdims=True) / obs3.sum()
    assert r3["chi2"] == pytest.approx(((obs3 - exp3) ** 2 / exp3).sum())


def test_welch_and_cohens_d(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(1, 2, 40), rng.normal(0, 1, 70)
    rows = [(1, float(x)) for x in a] + [(0, float(x)) for x in b]
    r = S.welch_t(spark.createDataFrame(rows, "Churn int, x double"), ["x"]).first()
    va, vb = a.var(ddof=1), b.var(ddof=1)
    t = (a.mean() - b.mean()) / math.sqrt(va / 40 + vb / 70)
    dfw = (va / 40 + vb / 70) ** 2 / ((va / 40) ** 2 / 39 + (vb / 70) ** 2 / 69)
    assert r["t_stat"] == pytest.approx(t)
    assert r["df"] == pytest.approx(dfw)
    assert r["cohens_d"] == pytest.approx((a.mean() - b.mean()) / math.sqrt((va + vb) / 2))


def test_policy_ties_bands_and_value(spark):
    econ = Economics()
    rng = np.random.default_rng(7)
    p = rng.uniform(0, 1, 800)
    df = spark.createDataFrame([(str(i), float(x), "One year", 70.0) for i, x in enumerate(p)],
                               "customerID string, churn_probability double, Contract string, MonthlyCharges double")
    a = PO.assign_actions(df, econ).cache()
    rank = {"do_nothing": 0, "discount": 1, "call": 2}
    means = {r["recommended_action"]: r["m"] for r in
             a.groupBy("recommended_action").agg(F.avg("churn_probability").alias("m")).collect()}
    ordered = [means[k] for k in sorted(means, key=rank.get)]
    assert ordered == sorted(ordered)
    b = spark.range(1).select(PO.band_boundaries(F.lit(econ.customer_value), econ).alias("b")).first()["b"]
    assert b["do_nothing_to_discount"] <= b["discount_to_call"]
    assert b["do_nothing_to_discount"] == pytest.approx(30 / (0.25 * econ.customer_value))
    summ = PO.policy_summary(a, econ).toPandas()
    assert set(summ["action"]) == {"do_nothing", "discount", "call"}
    total = a.agg(F.sum("expected_value_of_action")).first()[0]
    assert summ["expected_value"].sum() == pytest.approx(total, abs=0.05)
    assert summ["expected_value"].sum() >= -1e-6
    # exact tie between discount and call goes to the cheaper action
    v = 100.0
    tie_p = (econ.call_cost - econ.discount_cost) / ((econ.call_success - econ.discount_success) * v)
    t = spark.createDataFrame([("x", tie_p, v)], "customerID string, churn_probability double, clv double")
    d, c = PO.expected_values(F.col("churn_probability"), F.col("clv"), econ)
    row = PO.assign_actions(t, econ).withColumn("d", d).withColumn("c", c).first()
    if row["d"] == row["c"] and row["d"] > 0:
        assert row["recommended_action"] == "discount"


def test_kaplan_meier_matches_counting(spark):
    rng = np.random.default_rng(4)
    rows = [(float(t), int(e), "a" if i % 3 else "b") for i, (t, e) in
            enumerate(zip(rng.exponential(10, 3000).round(3), rng.integers(0, 2, 3000)))]
    df = spark.createDataFrame(rows + [(None, 1, "a"), (1.0, 1, None)], "tenure double, Churn int, g string")
    got = SV.km_table(df, group="g").toPandas().sort_values(["g", "timeline"])
    assert set(got["g"]) == {"a", "b"}
    for g, part in got.groupby("g"):
        t = np.array([r[0] for r in rows if r[2] == g])
        e = np.array([r[1] for r in rows if r[2] == g])
        s = 1.0
        for x in part.itertuples():
            n, d = (t >= x.timeline).sum(), e[t == x.timeline].sum()
            s *= 1 - d / n
            assert (x.n_at_risk, x.n_events) == (n, d) and x.survival == pytest.approx(s, abs=1e-12)
    assert set(SV.median_survival(df, "g").toPandas()["g"]) == {"a", "b"}


def test_missing_values_are_no_level_score_or_rank(spark):
    scores = spark.createDataFrame([(1, .9), (0, .1), (0, .5), (1, None), (0, float("nan")), (None, .3)], "Churn int, churn_probability double")
    assert M.ranking_metrics(scores).first()["roc_auc"] == 1.0
    assert {r["tpr"] for r in M.curve_points(scores).collect()} == {1.0}
    rows = [("x", 1)] * 30 + [("x", 0)] * 20 + [("y", 1)] * 10 + [("y", 0)] * 40
    plain = S.chi_square(spark.createDataFrame(rows, "c string, Churn int"), ["c"]).collect()
    assert S.chi_square(spark.createDataFrame(rows + [(None, 1)] * 25, "c string, Churn int"), ["c"]).collect() == plain
    values = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (4.0,), (None,)], "v double")
    assert exact_quantiles(values, "v", [0.5]) == [2.0]
    wide = spark.createDataFrame([(-1e308,), (0.0,), (1e308,)], "v double")
    assert exact_quantiles(wide, "v", [0.5]) == [0.0]


def test_cox_without_convergence_is_empty(spark):
    df = spark.createDataFrame([(float(i % 9 + 1), int(i % 3 > 0), float(i % 5)) for i in range(60)], "tenure double, Churn int, x1 double")
    with pytest.warns(UserWarning, match="converge"):
        assert SV.cox_ph(df, ["x1"], max_iter=1).count() == 0
    with pytest.warns(UserWarning, match="events"):
        assert SV.cox_ph(df.where("Churn = 0"), ["x1"]).count() == 0


def test_record_sink_takes_one_row_only(spark, tmp_dir):
    from keepwise.sources.sinks import write_record
    for n in (0, 2):
        with pytest.raises(ValueError):
            write_record(spark.range(n), tmp_dir + "/record")


def _numpy_cox(t, e, x, penalizer):
    """Reference Newton fit of the Efron partial likelihood (standardised x, ridge 0.5*n*pen*|b|^2)."""
    n, p = x.shape
    mu, sd = x.mean(0), x.std(0, ddof=1)
    z = (x - mu) / sd
    b = np.zeros(p)
    for _ in range(50):
        w = np.exp(z @ b)
        g, h = np.zeros(p), np.zeros((p, p))
        for tj in np.unique(t[e == 1]):
            risk = t >= tj
            dead = (t == tj) & (e == 1)
            d = dead.sum()
            s0, s1 = w[risk].sum(), (w[risk, None] * z[risk]).sum(0)
            s2 = (w[risk, None, None] * z[risk, :, None] * z[risk, None, :]).sum(0)
            e0, e1 = w[dead].sum(), (w[dead, None] * z[dead]).sum(0)
            e2 = (w[dead, None, None] * z[dead, :, None] * z[dead, None, :]).sum(0)
            g += z[dead].sum(0)
            for l_ in range(d):
                a = l_ / d
                f0, f1, f2 = s0 - a * e0, s1 - a * e1, s2 - a * e2
                g -= f1 / f0
                h -= f2 / f0 - np.outer(f1, f1) / f0 ** 2
        g -= n * penalizer * b
        h -= n * penalizer * np.eye(p)
        step = np.linalg.solve(h, g)
        b -= step
        if np.abs(step).max() < 1e-10:
            break
    return b / sd


def test_cox_matches_numpy_efron(spark):
    rng = np.random.default_rng(9)
    n = 300
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n)]).astype(float)
    t = rng.integers(1, 15, n).astype(float)            # many ties
    e = (rng.uniform(size=n) < 0.6).astype(int)
    df = spark.createDataFrame([(float(a), int(b), float(c), float(d)) for a, b, c, d in zip(t, e, x[:, 0], x[:, 1])],
                               "tenure double, Churn int, x1 double, x2 double")
    got = {r["feature"]: r["coef"] for r in SV.cox_ph(df, ["x1", "x2"], penalizer=0.1).collect()}
    want = _numpy_cox(t, e, x, 0.1)
    assert got["x1"] == pytest.approx(want[0], abs=1e-8)
    assert got["x2"] == pytest.approx(want[1], abs=1e-8)


def test_kaplan_meier_include_zero(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "tenure int, Churn int")
    rows = {r["timeline"]: r for r in SV.km_table(df, include_zero=True).collect()}
    assert rows[0.0]["survival"] == 1.0 and rows[0.0]["n_at_risk"] == 3
    assert rows[1.0]["survival"] == pytest.approx(2 / 3)


def test_average_precision_evaluator_on_vector_probabilities(spark):
    from pyspark.ml.linalg import Vectors
    from keepwise.models.evaluation import AveragePrecisionEvaluator
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    p = np.round(np.clip(0.3 * y + rng.uniform(0, 0.7, 300), 0, 1), 2)
    df = spark.createDataFrame([(float(a), Vectors.dense([1 - b, b])) for a, b in zip(y, p)], ["label", "probability"])
    ap, _ = _brute_ap_auc(y, p)
    assert AveragePrecisionEvaluator().evaluate(df) == pytest.approx(ap, abs=1e-12)
    assert AveragePrecisionEvaluator().isLargerBetter()


def test_cox_tie_sums_in_closed_form(spark):
    def tie_sums(a, d):
        y = [a - i for i in range(d)]
        return math.fsum(map(math.log, y)), math.fsum(1 / v for v in y), math.fsum(1 / v ** 2 for v in y)

    cases = [(float(a), float(d)) for d in (1, 2, 11, 12, 13, 14, 50, 5000) for a in (d, d + 0.25, d + 3.7, 2.0 * d, 1e3 * d, 1e8 * d)]
    df = spark.createDataFrame(cases, "a double, d double")
    cols = SV._tie_sums(F.col("a"), F.col("d"))
    for r in df.select("a", "d", *[c.alias(f"s{i}") for i, c in enumerate(cols)]).collect():
        for i, want in enumerate(tie_sums(r["a"], int(r["d"]))):
            assert r[f"s{i}"] == pytest.approx(want, rel=1e-11), (r["a"], r["d"], i)


def test_cox_with_many_ties_matches_numpy(spark):
    rng = np.random.default_rng(8)
    n = 3000
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n)])
    t = np.ceil(rng.exponential(np.exp(-0.6 * x[:, 0]) * 3)).clip(1, 6)        # six durations: hundreds of ties each
    e = (rng.random(n) < 0.7).astype(int)
    df = spark.createDataFrame([(float(a), int(b), float(c), float(f)) for a, b, c, f in zip(t, e, x[:, 0], x[:, 1])], "tenure double, Churn int, x1 double, x2 double")
    got = {r["feature"]: r["coef"] for r in SV.cox_ph(df, ["x1", "x2"], penalizer=0.1).collect()}
    want = _numpy_cox(t, e, x, 0.1)
    assert [got["x1"], got["x2"]] == pytest.approx(list(want), abs=1e-8)
