"""Vector operators against brute force, and awkward rows."""
import math

import numpy as np
import pytest

pytest.importorskip("keepwise.llm.queries")
from keepwise.llm import hard_negatives, whitening  # noqa: E402
from keepwise.llm.queries import QUERIES  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, x int, g int, b int, n int, k int, whitened int, rank int, deviation int"
AWKWARD = [(None, [0.1] * 6, 1), (901, None, 1), (902, [0.1, None, 0.2, 0.1, 0.3, 0.2], 2), (903, [math.nan] + [0.1] * 5, 2),
           (904, [math.inf] + [0.1] * 5, 2), (905, [], 1), (950, [0.5, 0.5], 1), (951, [0.3] * 6, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 8) for r in rows], SCHEMA)


def vectors(n, d=6, seed=1, ties=False):
    x = np.random.default_rng(seed).normal(size=(n, d))
    x = np.round(x) / 4 if ties else x / np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(np.float32(c)) for c in v], i * 7 % 3) for i, v in enumerate(x)]


def brute_negatives(rows, k=5, m=3):
    rows = {i: ((label + 1) % 10 if i % 7 == 0 else label, np.floor(256 * np.array(v)).astype(int)) for i, v, label in rows}
    out = set()
    for a, (own, q) in rows.items():
        if a % 50 == 0:
            ranked = sorted((-int(q @ x), i, label) for i, (label, x) in rows.items() if i != a)
            for p, pid, _ in [r for r in ranked if r[2] == own][:k]:
                band = [r for r in ranked if r[2] != own and 50 * -p <= 100 * -r[0] <= 95 * -p][:m]
                out |= {(a, pid, at, r[1], -p, -r[0]) for at, r in enumerate(band, 1)}
    return out


@pytest.mark.parametrize("d, ties", [(6, False), (6, True), (70, False)])
def test_hard_negatives(spark, monkeypatch, d, ties):
    monkeypatch.setattr(hard_negatives, "_GROUP_ROWS", 150)
    monkeypatch.setattr(hard_negatives, "_BLOCK_ANCHORS", 4)
    rows = vectors(400, d, ties=ties)
    copies = [(500 + i, rows[50][1], rows[50][2]) for i in range(60)]       # a group of copies of an anchor
    awkward = AWKWARD if d == 6 else []
    got = hard_negatives.mined_negatives(frame(spark, rows + copies + awkward + rows[:3])).collect()
    assert {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got} == brute_negatives(rows + copies)
    assert len(got) == len(brute_negatives(rows + copies))


def test_intervals_hold_and_narrow():
    x = np.floor(256 * np.array([v for _, v, _ in vectors(300, 70)])).astype(np.int64)
    widths = []
    for levels in (1, 3, 6):
        turns = hard_negatives.rotations(70, levels)
        low, high = hard_negatives.intervals(x[:40], hard_negatives.Codes(x, turns), turns)
        true = x[:40] @ x.T
        assert (low <= true).all() and (true <= high).all()
        widths.append((high - low).mean())
    assert widths[2] < 0.15 * widths[0]


def test_no_vectors(spark):
    none = frame(spark, [])
    assert hard_negatives.mined_negatives(none).count() == 0 and whitening.whitened_embeddings(none).count() == 0
    some = frame(spark, AWKWARD)
    assert hard_negatives.mined_negatives(some).count() == 0
    assert hard_negatives.mined_negatives(frame(spark, [(50, [1.0, 0.0], 1), (51, [-1.0, 0.0], 1), (52, [0.0, 1.0], 2)])).count() == 0


def brute_whitening(rows, k):
    x = np.floor(64 * np.array([v for _, v, _ in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = x - s / n
    e, axes = np.linalg.eigh(z.T @ z / n)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    return ((n * x - s) ** 2).sum(axis=1), z @ axes / np.sqrt(e), e / (z ** 2).sum() * n


@pytest.mark.parametrize("d, k", [(6, 4), (6, 32), (40, 32)])
def test_whitening(spark, d, k):
    rows = vectors(300, d, seed=3)
    rows += [(1000 + i, rows[5][1], 0) for i in range(150)]                # a third of all rows alike
    deviation, white, explained = brute_whitening(rows, k)
    got = whitening.whitened_embeddings(frame(spark, rows + (AWKWARD[1:7] if d == 6 else [])), components=k).toPandas()
    at = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r[0] for r in rows]].to_numpy()
    assert at.shape == white.shape and len(got) == white.size
    assert np.abs(at * np.sign((at * white).sum(axis=0)) - white).max() < 1e-9
    assert (got.groupby("vec_id").deviation.first().loc[[r[0] for r in rows]].to_numpy() == deviation).all()
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-9) and got.identity_error.max() < 1e-9
    assert set(got.n) == {len(rows)}


def test_whitening_of_flat_and_repeated_directions(spark):
    """Eigenvalues that repeat exactly, and directions without variance."""
    base = np.vstack([np.eye(4), -np.eye(4)])
    rows = [(i, [*map(float, 2 * v), 0.5, float(v.sum())], 0) for i, v in enumerate(base)] + [(None, [0.0] * 4 + [0.5, 0.0], 0)]
    got = whitening.whitened_embeddings(frame(spark, rows)).toPandas()
    assert sorted(got.component.unique()) == [1, 2, 3, 4] and len(got) == 4 * len(rows) and got.identity_error.max() < 1e-9
    assert whitening.whitened_embeddings(frame(spark, [rows[0]] * 5)).count() == 0


def test_whitening_query(spark, sf_dir):
    got = QUERIES["op13_whitening"](spark, sf_dir).agg({"identity_error": "max", "component": "max", "*": "count"}).first()
    assert got[0] < 1e-4 and got[1] == 32 and got[2] % 32 == 0
