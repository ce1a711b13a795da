"""Hard negatives by rotated one-bit codes.

A row stores, for each of ``levels`` rotations, the signs of the rotated vector
(one bit per dimension), their alignment (the vector's product with the unit
code vector) and passes what the aligned code leaves on to the next rotation;
the length of the last remainder is stored too. An anchor keeps its rotated
vector in eight-bit numbers, cut into bit planes, so its products with all codes
are popcounts. Estimate = alignments times those products; the rest of the true
score is the product of the two remainders, at most the product of their lengths
(Cauchy-Schwarz, with the remainder's right angle to its last code), plus the
exactly known loss of the eight-bit numbers. These intervals hold for certain:
a row whose interval cannot reach an anchor's list is skipped, all others are
scored in whole numbers.

Anchors meet all rows block by block (a group of rows x a block of anchors),
in two rounds: the first finds each anchor's positives, the second the negatives
in each positive's band. A block returns its own best rows, so what is merged
per anchor is a few rows per group.
"""
from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepwise.llm.common import saved
from keepwise.llm.vectors import of_common_length, scaled_floor, usable
from keepwise.session import ship_package

_GROUP_ROWS = 4096
_BLOCK_ANCHORS = 2048
_CHUNK = 32            # anchors of a matrix of intervals
_PLANES = 8


def rotations(d: int, levels: int) -> list[np.ndarray]:
    """Fixed random orthogonal matrices."""
    return [np.linalg.qr(np.random.default_rng(1000 + i).normal(size=(d, d)))[0] for i in range(levels)]


class Codes:
    """Codes of the rows of x: bits (level, row, words), alignment (level, row), remainder (row)."""

    def __init__(self, x: np.ndarray, turns: list[np.ndarray]):
        rest, self.bits, self.alignment = x.astype(float), [], []
        root = math.sqrt(x.shape[1])
        for turn in turns:
            rest = rest @ turn.T
            up = rest >= 0
            self.bits.append(_packed(up))
            self.alignment.append(np.abs(rest).sum(axis=1) / root)
            rest = rest - np.where(up, 1.0, -1.0) * (self.alignment[-1] / root)[:, None]
        self.remainder = np.linalg.norm(rest, axis=1)
        self.length = np.linalg.norm(x.astype(float), axis=1)


def _packed(up: np.ndarray) -> np.ndarray:
    words = -(-up.shape[1] // 64)
    wide = np.zeros((len(up), words * 64), bool)
    wide[:, :up.shape[1]] = up
    return np.packbits(wide, axis=1).view(np.uint64)


def intervals(anchors: np.ndarray, codes: Codes, turns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) score that each anchor (row) can have with each coded row (column)."""
    d = anchors.shape[1]
    root = math.sqrt(d)
    q = anchors.astype(float)
    length = np.linalg.norm(q, axis=1)
    middle, slack, last, blur = 0.0, 0.0, 0.0, 0.0
    for turn, bits, alignment in zip(turns, codes.bits, codes.alignment):
        q = q @ turn.T
        low = q.min(axis=1)
        step = np.maximum(q.max(axis=1) - low, 1e-300) / (2 ** _PLANES - 1)
        small = np.clip(np.rint((q - low[:, None]) / step[:, None]), 0, 2 ** _PLANES - 1).astype(np.uint8)
        counts = np.zeros((len(q), len(bits[:, 0])), np.int32)
        for p in range(_PLANES):
            plane = _packed((small >> p & 1).astype(bool))
            for word in range(plane.shape[1]):
                counts += np.bitwise_count(plane[:, word, None] & bits[None, :, word]).astype(np.int32) << p
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int32)
        # sum of q over set bits minus over clear bits, for q read as low + step * small
        last = (step[:, None] * (2 * counts - small.sum(axis=1, dtype=np.int32)[:, None]) + low[:, None] * (2 * ones - d)[None, :]) / root
        blur = np.linalg.norm(q - (low[:, None] + step[:, None] * small), axis=1)
        middle = middle + last * alignment[None, :]
        slack = slack + blur[:, None] * alignment[None, :]
    beside = np.sqrt(np.maximum(length[:, None] ** 2 - np.maximum(np.abs(last) - blur[:, None], 0) ** 2, 0))
    slack = slack + beside * codes.remainder[None, :] + 1e-9 * (1 + length[:, None] * codes.length[None, :])
    return middle - slack, middle + slack


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _positives(k: int, levels: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            x, ids, label = np.stack(rows["x"]), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            turns = rotations(x.shape[1], levels)
            codes = Codes(x, turns)
            for at in range(0, len(anchors), _CHUNK):
                part = anchors.iloc[at:at + _CHUNK]
                q = np.stack(part["x"])
                low, high = intervals(q, codes, turns)
                for i, (anchor, own) in enumerate(zip(part["vec_id"], part["label"])):
                    mine = np.flatnonzero((label == own) & (ids != anchor))
                    mine = mine[high[i, mine] >= _kth(low[i, mine], k)]
                    scores = x[mine] @ q[i]
                    best = _top(ids[mine], scores, k)
                    out += zip([anchor] * len(best), ids[mine[best]], scores[best])
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"]).astype("int64")
    return run


def _negatives(k: int, low_percent: int, high_percent: int, levels: int):
    def run(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(wanted):
            x, ids, label = np.stack(rows["x"]), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            turns = rotations(x.shape[1], levels)
            codes = Codes(x, turns)
            groups = [g for _, g in wanted.groupby("vec_id", sort=False)]
            for at in range(0, len(groups), _CHUNK):
                part = groups[at:at + _CHUNK]
                q = np.stack([g["x"].iloc[0] for g in part])
                low, high = intervals(q, codes, turns)
                for i, g in enumerate(part):
                    other = np.flatnonzero(label != g["label"].iloc[0])
                    lo, hi = low[i, other], high[i, other]
                    for positive, score in zip(g["positive_id"], g["positive_score"]):
                        sure = (100 * lo >= low_percent * score) & (100 * hi <= high_percent * score)
                        least = _kth(lo[sure], k)
                        may = other[(hi >= least) & (100 * hi >= low_percent * score) & (100 * lo <= high_percent * score)]
                        scores = x[may] @ q[i]
                        fits = (100 * scores >= low_percent * score) & (100 * scores <= high_percent * score)
                        may, scores = may[fits], scores[fits]
                        best = _top(ids[may], scores, k)
                        out += zip([g["vec_id"].iloc[0]] * len(best), [positive] * len(best), [score] * len(best), ids[may[best]], scores[best])
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]).astype("int64")
    return run


def _best(rows: DataFrame, by: Iterable[str], score: str, id_col: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.col(id_col))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low_percent: int = 50,
                   high_percent: int = 95, levels: int = 6) -> DataFrame:
    """vectors (vec_id, label, x: array<long>) and anchors (vec_id) among them -> the anchors' hard negatives.

    For each anchor and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of
    another label with low_percent * positive_score <= 100 * score <= high_percent * positive_score:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Higher scores first, ties by
    smaller vec_id; exact for scores within a long. Rows of a null id or label take no part; rows that repeat
    a vec_id count as one (smallest label, then vector). All vectors have one length. Anchors without
    positives or with empty bands return nothing, as does an empty table.
    """
    rows = (vectors.filter("vec_id is not null and label is not null").groupBy("vec_id")
            .agg(F.min(F.struct("label", "x")).alias("v")).select("vec_id", "v.label", "v.x"))
    rows = saved(rows, "vectors")
    count = rows.count()
    groups = max(1, -(-count // _GROUP_ROWS))
    chosen = saved(rows.join(anchors.select("vec_id").distinct(), "vec_id", "left_semi"), "anchors")
    blocks = max(1, -(-chosen.count() // _BLOCK_ANCHORS))
    spread = lambda name, n: F.pmod(F.xxhash64("vec_id", F.lit(name)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("g", spread("group", groups)).withColumn("b", every(blocks)).groupBy("g", "b")

    def met(queries: DataFrame, run, schema: str) -> DataFrame:
        right = queries.withColumn("b", spread("block", blocks)).withColumn("g", every(groups)).groupBy("g", "b")
        return left.cogroup(right).applyInPandas(run, schema)

    near = met(chosen, _positives(positives, levels), "anchor_id long, positive_id long, positive_score long")
    near = saved(_best(near, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"), "positives")
    wanted = saved(chosen.join(near.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "wanted")
    found = met(wanted, _negatives(negatives, low_percent, high_percent, levels),
                "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    return (_best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def mined_negatives(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    relabel_every: int = 7, anchor_every: int = 50, scale: int = 256, labels: int = 10, **settings) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``anchor_every``.

    Entries become floor(scale * entry). Where the id is divisible by ``relabel_every`` the label first
    becomes (label + 1) % labels. Rows with a null id or label, a null vector, null or non-finite entries, no
    entries, or another length than the commonest take no part; other columns are ignored.
    """
    ship_package(embeddings.sparkSession)
    vec_id, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    rows = (embeddings.filter(usable(F.col(vector_col)) & vec_id.isNotNull() & label.isNotNull())
            .select(vec_id.alias("vec_id"), F.when(vec_id % relabel_every == 0, (label + 1) % labels).otherwise(label).alias("label"),
                    scaled_floor(F.col(vector_col), scale).alias("x")))
    rows = of_common_length(saved(rows, "whole"), "x")
    return hard_negatives(rows, rows.filter(F.col("vec_id") % anchor_every == 0), **settings)
