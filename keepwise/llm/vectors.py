"""Rows with usable vectors, as whole numbers."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """The vector is there, has entries, and every entry is there and finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def scaled_floor(vector: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * entry) + shift of every entry, entries taken as double."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)).cast("long") + F.lit(shift).cast("long"))


def of_common_length(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has the commonest length (ties: the longer); vectors of other lengths have no place beside them."""
    lengths = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size(vector) == (lengths.d if lengths else 0))


def matrix(column: pa.ListArray) -> np.ndarray:
    """The rows of a list column of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
