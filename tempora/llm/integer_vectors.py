"""Vectors as whole numbers, and exact sums over groups of them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, need_columns

#: Tables of totals up to this many rows are broadcast (some 40 bytes each).
BROADCAST_TOTALS = 50_000


def magnitude_limit(length: int) -> int:
    """The largest size of a component for which squared distances over ``length`` of them fit a long."""
    return int(math.isqrt((1 << 62) // max(1, length)) // 2)


def floored(vectors: DataFrame, scale: int, vector: str, *columns: str) -> DataFrame:
    """The named columns, and ``whole``: each component as floor(scale * x), x as double. Rows whose vector is null
    or holds a null or non-finite component are left out."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    chosen = need_columns(vectors, *columns, vector).withColumn("_x", F.col(f"`{vector}`").cast("array<double>"))
    good = chosen.where(F.col("_x").isNotNull() & F.forall("_x", finite))
    whole = F.transform("_x", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(1 << 30))), F.lit(-float(1 << 30)))).cast("int"))
    return good.select(*[F.col(f"`{c}`") for c in columns], whole.alias("whole"))


def within_limit(whole: Column, length: int) -> Column:
    """Components no larger in size than ``magnitude_limit``."""
    limit = min(magnitude_limit(length), 1 << 30)
    return F.transform(whole, lambda x: F.greatest(F.least(x, F.lit(limit)), F.lit(-limit)))


def rows_of(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


class GroupSums:
    """Sums of rows by group within one task; groups times length numbers, whatever the rows."""

    SCHEMA = "cell int, position int, total long, members long"

    def __init__(self, cells: int, length: int):
        self.total = np.zeros((cells, length), dtype=np.int64)
        self.members = np.zeros(cells, dtype=np.int64)

    def add(self, rows: np.ndarray, cell: np.ndarray) -> None:
        np.add.at(self.total, cell, rows)
        self.members += np.bincount(cell, minlength=len(self.members))

    def batches(self) -> Iterator[pa.RecordBatch]:
        cells, length = self.total.shape
        used = np.repeat(self.members > 0, length)
        if used.any():
            columns = [np.repeat(np.arange(cells, dtype=np.int32), length), np.tile(np.arange(length, dtype=np.int32), cells), self.total.ravel(), np.repeat(self.members, length)]
            yield pa.RecordBatch.from_arrays([pa.array(c[used]) for c in columns], names=["cell", "position", "total", "members"])


def floor_means(partial: DataFrame, old: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cell; cells without a member keep their old row."""
    new = old.copy()
    for row in partial.groupBy("cell", "position").agg(F.sum("total").alias("total"), F.sum("members").alias("members")).collect():  # cells times length rows
        new[row.cell, row.position] = row.total // row.members
    return new


def with_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """rows with ``name``, the sum of ``value`` over rows of an equal key (nulls together). The table of totals is
    broadcast where it is counted to be small; else the join is by shuffle, and its hot keys are split."""
    totals = materialise(rows.groupBy(F.col(key).alias("_of")).agg(F.sum(value).alias(name)), "vector-totals")
    if totals.count() <= BROADCAST_TOTALS:
        return rows.join(F.broadcast(totals), F.col(key).eqNullSafe(F.col("_of")), "left").drop("_of")
    salts = 16
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in rows.dtypes]), F.lit(salts)).cast("int"))
    spread = totals.withColumn("_spread", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(spread, F.col(key).eqNullSafe(F.col("_of")) & (F.col("_salt") == F.col("_spread")), "left").drop("_of", "_salt", "_spread")
