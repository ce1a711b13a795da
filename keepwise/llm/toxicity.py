"""Toxicity by a factorization machine over hashed terms.

Terms of a document: its distinct words and their prefixes of four and five letters, each
hashed to one of ``2 ** bits`` slots. Every slot has a linear weight and a factor vector, and
every term of a text takes part; none is chosen or dropped. What a slot counts for is its value

    df / (df + 20) * (0.1 + 0.9 * z^2 / (z^2 + 30)),

with df and z (its lean towards a class) from the fit's rows: words seen once or twice, of which
there are more than of all others, weigh little, so that the machine cannot learn its rows by heart, and a
frequent word without a lean of its own keeps a tenth of its value, enough to learn what it means beside another. AdaGrad on
the logistic loss, a share of the terms left out of each step, fits on at most ``sample_rows``
labelled rows; every whole text is scored in Arrow batches.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from keepwise.llm.common import saved, table_text
from keepwise.session import ship_package

_PREFIXES = (4, 5)
_SLICE = 256          # texts scored together
_PIECE = 1000         # rows of the sample that come to the driver together


@dataclass(frozen=True)
class FactorModel:
    bias: float
    slots: np.ndarray      # slots x (1 + k), float32: linear weight and factors, times the slot's value

    @property
    def bits(self) -> int:
        return len(self.slots).bit_length() - 1


def hashed_terms(text: Column, bits: int) -> Column:
    """Distinct slots of a text's terms; null and empty texts have none."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"))
    hashed = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits)).cast("int")

    def terms(w: Column) -> Column:
        starts = [F.when(F.length(w) > n, hashed(F.concat(F.lit("^"), F.substring(w, 1, n)))) for n in _PREFIXES]
        return F.array(F.when(w != "", hashed(w)), *starts)

    return F.array_compact(F.array_distinct(F.flatten(F.transform(words, terms))))


def _flat(ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, value) of every element of a list column; null lists have none."""
    sizes = np.diff(ids.offsets.to_numpy(zero_copy_only=False))
    return np.repeat(np.arange(len(ids)), sizes), ids.flatten().to_numpy(zero_copy_only=False)


def _sums(x: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the sums of all columns, and of the squared factors."""
    sums = np.stack([np.bincount(rows, x[:, f], n) for f in range(x.shape[1])], axis=1)
    return sums, np.bincount(rows, (x[:, 1:].astype(float) ** 2).sum(axis=1), n)


def margins(model: FactorModel, n: int, rows: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """bias + sum of weights + sum over pairs of the products of their factors, for (row, slot) pairs."""
    sums, squares = _sums(model.slots[slots], rows, n)
    return model.bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def slot_values(starts: np.ndarray, slots: np.ndarray, labels: np.ndarray, bits: int) -> np.ndarray:
    df, positive, share = np.zeros(1 << bits), np.zeros(1 << bits), labels.mean()
    for at in range(0, len(labels), _SLICE):                  # a slice's counts at a time: nothing as long as all terms
        sizes = np.diff(starts[at:at + _SLICE + 1])
        part = slots[starts[at]:starts[at] + sizes.sum()]
        df += np.bincount(part, minlength=1 << bits)
        positive += np.bincount(part, np.repeat(labels[at:at + _SLICE], sizes), 1 << bits)
    z2 = (positive - df * share) ** 2 / np.maximum(df * share * (1 - share), 1e-9)
    return df / (df + 20) * (0.1 + 0.9 * z2 / (z2 + 30))


def train_factors(starts: np.ndarray, slots: np.ndarray, labels: np.ndarray, bits: int, k: int = 4, visits: int = 120_000, batch: int = 128,
                  rate: float = 0.5, decay: float = 1e-4, left_out: float = 0.3, seed: int = 7) -> FactorModel:
    """Row i has the slots from starts[i] to starts[i + 1]; labels 0 / 1, both present. ``visits``: rows seen in all passes together."""
    rng = np.random.default_rng(seed)
    n = len(labels)
    value = slot_values(starts, slots, labels, bits).astype(np.float32)
    p = np.zeros((1 << bits, k + 1), np.float32)
    p[:, 1:] = rng.normal(0, 0.01, (1 << bits, k))
    seen = np.full((1 << bits, k + 1), 1e-4, np.float32)
    bias, seen_bias = float(np.log((labels.sum() + 1) / (n - labels.sum() + 1))), 1e-6
    for _ in range(min(100, -(-visits // n))):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            chosen = np.sort(order[lo:lo + batch])
            r = np.repeat(np.arange(len(chosen)), starts[chosen + 1] - starts[chosen])
            a = np.concatenate([slots[starts[i]:starts[i + 1]] for i in chosen])
            keep = rng.random(len(a)) >= left_out
            a, r = a[keep], r[keep]
            used, at = np.unique(a, return_inverse=True)
            v = value[used][:, None]
            x = (p[used] * v)[at]
            sums, squares = _sums(x, r, len(chosen))
            margin = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            slope = (_probability(margin) - labels[chosen]) / len(chosen)
            step = np.empty((len(used), k + 1))
            step[:, 0] = np.bincount(at, slope[r], len(used))
            for f in range(1, k + 1):
                step[:, f] = np.bincount(at, slope[r] * (sums[r, f] - x[:, f]), len(used))
            step = step * v + decay * p[used]
            seen[used] += step ** 2
            p[used] -= rate * step / np.sqrt(seen[used])
            seen_bias += slope.sum() ** 2
            bias -= 0.1 * slope.sum() / np.sqrt(seen_bias)
    return FactorModel(float(bias), p * value[:, None])


def _collected(sample: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, starts, slots) of at most ``rows`` rows (y, ids, place), by place: a piece of ``_PIECE`` rows at a time passes the
    driver's JVM, which keeps what a single large result took of it."""
    labels, sizes, slots = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for at in range(0, rows, _PIECE):
        piece = sample.filter(F.col("place").between(at, at + _PIECE - 1)).orderBy("place").select("y", "ids").toArrow()
        if not piece.num_rows:
            break
        ids = piece["ids"].combine_chunks()
        labels.append(piece["y"].to_numpy().astype(float))
        sizes.append(np.diff(ids.offsets.to_numpy()).astype(np.int64))
        slots.append(ids.flatten().to_numpy(zero_copy_only=False).copy())
    return np.concatenate(labels), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), np.concatenate(slots)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", bits: int = 18, sample_rows: int = 20_000) -> FactorModel:
    """Fit on labelled rows of ``docs``: at most ``sample_rows`` of them, in the order of a hash of the id.

    Rows with a null id or label are left out; an id labelled several times has its largest label; rows that repeat an
    id each count. Without rows of both classes the model scores the prior (0.5 without any label).
    """
    ship_package(docs.sparkSession)
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y")))
    texts = table_text(docs, id_col, text_col)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.join(texts.select("doc_id"), "doc_id", "left_semi").orderBy(*order).limit(sample_rows)
    # the chosen labels are at most ``sample_rows`` pairs of numbers
    ids = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", hashed_terms(F.col("text"), bits).alias("ids"))
    sample = ids.orderBy(*order, F.xxhash64("ids")).limit(sample_rows).withColumn("place", F.monotonically_increasing_id())
    y, starts, slots = _collected(saved(sample, "sample"), sample_rows)
    if len(set(y)) < 2:
        return FactorModel(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros((1 << bits, 2), np.float32))
    return train_factors(starts, slots, y, bits)


def toxic_score(model: FactorModel, text: Column) -> Column:
    """The model's probability of toxicity, 0 to 1; null and empty texts get the score of no term."""
    @arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for at in range(0, len(column), _SLICE):
            part = column.slice(at, _SLICE)
            out.append(_probability(margins(model, len(part), *_flat(part))))
        return pa.array(np.concatenate(out))

    return score(hashed_terms(text, model.bits))


def score_documents(docs: DataFrame, model: FactorModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: one row per row of ``docs``.

    Whole texts are read. Null and empty texts have a score too; equal texts have equal scores; repeated rows and a null
    doc_id keep their rows; other columns, whatever their names, are ignored; an empty table gives an empty table.
    """
    ship_package(docs.sparkSession)
    return table_text(docs, id_col, text_col).select("doc_id", toxic_score(model, F.col("text")).alias("score"))


def in_training(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, mod 3, is not 1."""
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1
