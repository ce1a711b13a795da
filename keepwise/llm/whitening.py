"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

With Z the centred rows, each step multiplies once by Z and once by its
transpose in one distributed pass: a task computes u = Z_p w for its rows and
returns Z_p' u, u'u and the products of u with all earlier left vectors; Spark
adds these short vectors up. A left vector has one entry per row and is never
stored: it is Z w for a vector w of the dimensions, so a lost executor costs a
task of the running pass and nothing else. Left and right vectors are both fully
reorthogonalised: right ones on the driver, left ones before the pass by the
products Z'u of earlier passes and after it by the products that the pass
returned. As many steps as dimensions run, from a new start vector whenever an
invariant space is exhausted, so repeated and zero eigenvalues are complete too.
The small bidiagonal matrix's singular vectors give components and deviations.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwise.llm.common import saved
from keepwise.llm.vectors import matrix, of_common_length, scaled_floor, usable
from keepwise.session import ship_package

_ROWS = 2048           # rows of a block of numpy work
_ZERO = 1e-10          # of the largest coefficient: smaller ones end an invariant space


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]      # per dimension, over the fit rows
    components: np.ndarray     # dimensions x components, unit columns
    variances: np.ndarray      # per component, falling
    trace: float


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n; whole part and fraction of the mean apart, so large means lose no digits."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _blocks(batch: pa.RecordBatch, name: str):
    for at in range(0, batch.num_rows, _ROWS):
        yield matrix(batch.column(name).slice(at, _ROWS))


def _summed(rows: DataFrame, n: int, sums: np.ndarray, partial) -> np.ndarray:
    """Sum over all rows of ``partial(centred block)``, a short vector."""
    def run(batches):
        total = None
        for batch in batches:
            for x in _blocks(batch, "x"):
                got = partial(_centred(x, n, sums))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["k", "v"])

    out = rows.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    return out["v"].to_numpy()[np.argsort(out["k"].to_numpy())]


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonal(rows: DataFrame, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(right vectors as columns, upper bidiagonal matrix) of the centred rows."""
    d = len(sums)
    rng = np.random.default_rng(17)
    right, left, back = [], [], []      # v_k; w_k with u_k = Z w_k; Z'u_k
    b = np.zeros((d, d))
    largest = 0.0
    v = rng.normal(size=d)
    for k in range(d):
        v = _orthogonal(v, right)
        v /= np.linalg.norm(v)
        right.append(v)
        w = v.copy()
        for wi, zi in zip(left, back):                     # against earlier left vectors: u_i'Z v = (Z'u_i)'v
            w -= (zi @ v) * wi
        if k and b[k - 1, k]:                              # the last product is beta itself
            b[k - 1, k] = back[-1] @ v
        earlier = np.array(left).T if left else np.zeros((d, 0))

        def partial(z, w=w, earlier=earlier):
            u = z @ w
            return np.concatenate([z.T @ u, [u @ u], (z @ earlier).T @ u])

        got = _summed(rows, n, sums, partial)
        zu, square, again = got[:d], got[d], got[d + 1:]
        for g, wi, zi in zip(again, left, back):           # second reorthogonalisation, on what the pass returned
            w = w - g * wi
            zu = zu - g * zi
            square -= g * g
        alpha = float(np.sqrt(max(square, 0.0)))
        largest = max(largest, alpha)
        if alpha <= _ZERO * largest:
            v = rng.normal(size=d)                         # u is zero: Z v lies in the earlier left vectors
            continue
        b[k, k] = alpha
        left.append(w / alpha)
        back.append(zu / alpha)
        if k + 1 < d:
            rest = _orthogonal(back[-1] - alpha * v, right)
            beta = float(np.linalg.norm(rest))
            largest = max(largest, beta)
            if beta <= _ZERO * largest:
                rest = rng.normal(size=d)
            else:
                b[k, k + 1] = beta
            v = rest
    return np.array(right).T, b


def fit_whitening(rows: DataFrame, components: int = 32) -> Whitening:
    """Fit on every row of ``rows`` (column x: array<long> of one length)."""
    totals = (rows.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
              .orderBy("k").collect())
    if not totals:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    n, sums = totals[0].n, np.array([t.s for t in totals], np.int64)
    right, b = bidiagonal(rows, n, sums)
    _, sigma, turn = np.linalg.svd(b)
    keep = int((sigma[:components] > _ZERO * max(sigma[0], 1e-300)).sum())
    axes = right @ turn[:keep].T
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(keep)])
    return Whitening(n, tuple(int(s) for s in sums), axes, sigma[:keep] ** 2 / n, float((b ** 2).sum() / n))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.variances)
    scale, sums = model.components / np.sqrt(model.variances), np.array(model.sums, np.int64)

    def partial(z):
        y = z @ scale
        return (y.T @ y).ravel()

    return float(np.abs(_summed(rows, model.n, sums, partial).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """rows + deviation (long) and whitened (array<double>, one entry per component)."""
    scale, sums = model.components / np.sqrt(model.variances), np.array(model.sums, np.int64)
    n, keep = model.n, rows.schema
    out = rows.withColumn("deviation", F.expr("0L")).withColumn("whitened", F.expr("cast(array() as array<double>)")).schema

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                x = matrix(part.column("x"))
                off = n * x - sums
                y = np.ascontiguousarray(_centred(x, n, sums) @ scale)
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * y.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep.names), pa.array((off * off).sum(axis=1)),
                     pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))], names=out.names)

    return rows.mapInArrow(run, out)


def whitened_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
                        scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries become floor(scale * entry) + shift; every remaining row is a fit row. Components are the
    covariance's unit eigenvectors (divisor n) by falling eigenvalue, largest entry positive; those of no
    variance cannot be whitened and are left out, so rows that are all equal, a single row and an empty
    table give no rows. Rows with a null vector, null or non-finite entries, no entries, or another length
    than the commonest are dropped. A null vec_id keeps its row; repeated rows count and return separately;
    equal eigenvalues share a space in which any axes may be returned; other columns are ignored.
    ``deviation`` is exact while n * |x - mean| stays under 2^31 or so per entry (a long holds it).
    """
    ship_package(vectors.sparkSession)
    rows = (vectors.filter(usable(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), scaled_floor(F.col(vector_col), scale, shift).alias("x")))
    rows = saved(of_common_length(saved(rows, "whole"), "x"), "fit")
    model = fit_whitening(rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not len(model.variances):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    share = F.array(*(F.lit(float(e / model.trace)) for e in model.variances))
    return (whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(share, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error")))
