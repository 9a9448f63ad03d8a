"""Curves along a timeline: novelty, periodicity, local keys, and channels of principal components with their drift."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PITCH_CLASSES
from .windows import ENTITY, order

#: Weight of each pitch class above the tonic in a major and a minor key. Fixed values.
MAJOR_PROFILE = [6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88]
MINOR_PROFILE = [6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17]


def novelty_curve(rows: DataFrame, vector: list[str], reach: int = 8, taper: list[int] | None = None) -> DataFrame:
    """rows with ``novelty``: a checkerboard kernel over the self-similarity (inner products) of the ``reach`` rows before and those from here on. The
    kernel is a product of weights by distance (``taper``, from the nearest row; equal by default), so its four blocks are inner products
    of two weighted sums, and no pair of rows is made: what is alike inside either side less what is alike across. Null within reach of the ends."""
    weights = taper or [1] * reach
    w = order()
    whole = (F.count("*").over(w.rowsBetween(-reach, -1)) == reach) & (F.count("*").over(w.rowsBetween(0, reach - 1)) == reach)
    total = None
    for c in vector:
        left = sum((F.lag(c, j + 1).over(w) * g for j, g in enumerate(weights[1:], 1)), F.lag(c, 1).over(w) * weights[0])
        right = sum((F.lead(c, j).over(w) * g for j, g in enumerate(weights[1:], 1)), F.col(c) * weights[0])
        gap = (right - left) * (right - left)
        total = gap if total is None else total + gap
    return rows.withColumn("novelty", F.when(whole, total / float(sum(weights) ** 2)))


def autocorrelation(rows: DataFrame, x: str, lags: int) -> DataFrame:
    """(entity_id, lag, n, correlation): of whole numbers x with themselves ``lag`` rows later, about the entity's mean, over its variance; null where x does not vary. Lagged
    products are summed exactly by entity, so an entity of any length is a few sums. Lags as long as an entity are left out."""
    w = order()
    later = F.array(*[F.lead(x, k).over(w) for k in range(1, lags + 1)])
    listed = rows.withColumn("_later", later).select(ENTITY, F.col(x).alias("x"), F.posexplode("_later").alias("_k", "y")).where("y is not null").select(ENTITY, (F.col("_k") + 1).alias("lag"), "x", "y")
    wide = lambda c: c.cast("decimal(38,0)")
    pairs = listed.groupBy(ENTITY, "lag").agg(F.count("*").alias("_m"), F.sum("x").alias("_sx"), F.sum("y").alias("_sy"), F.sum((F.col("x").cast("decimal(18,0)") * F.col("y")).cast("decimal(37,0)")).alias("_xy"))
    whole = rows.groupBy(ENTITY).agg(F.count("*").alias("n"), F.sum(x).alias("_s"), F.sum((F.col(x).cast("decimal(18,0)") * F.col(x)).cast("decimal(37,0)")).alias("_q"))
    n, s, m = F.col("n"), F.col("_s"), F.col("_m")
    # times n squared, all is whole: sum (x - s/n)(y - s/n)
    above = wide(n * n) * wide(F.col("_xy")) - wide(n * s) * wide(F.col("_sx") + F.col("_sy")) + wide(m) * wide(s) * wide(s)
    below = wide(n * n) * wide(F.col("_q")) - wide(n) * wide(s) * wide(s)
    return pairs.join(whole, ENTITY).select(ENTITY, "lag", "n", F.when(below > 0, F.round(above.cast("double") / below.cast("double"), 9)).alias("correlation"))


def periods(correlations: DataFrame, least: float = 0.1) -> DataFrame:
    """(entity_id, period, strength): the lag of highest correlation among those above both neighbours, the shortest on a tie, where it is at least ``least``."""
    w = Window.partitionBy(ENTITY).orderBy("lag")
    c = F.col("correlation")
    top = correlations.withColumns({"_b": F.lag("correlation").over(w), "_a": F.lead("correlation").over(w)}).where((c > F.col("_b")) & (c > F.col("_a")) & (c >= least))
    best = top.groupBy(ENTITY).agg(F.max_by(F.struct("lag", "correlation"), F.struct("correlation", -F.col("lag"))).alias("_t"))
    return best.select(ENTITY, F.col("_t.lag").alias("period"), F.col("_t.correlation").alias("strength"))


def _correlation(counts: list[Column], profile: list[float]) -> Column:
    """Pearson's correlation of twelve counts with a profile, null where the counts are equal."""
    centred = (np.array(profile) - np.mean(profile)).tolist()
    length = float(np.sqrt(np.square(centred).sum()))
    total = sum(counts[1:], counts[0])
    square = sum((c * c for c in counts[1:]), counts[0] * counts[0])
    spread = square * 12 - total * total
    above = sum((c * F.lit(p) for c, p in zip(counts[1:], centred[1:])), counts[0] * F.lit(centred[0]))
    return F.when(spread > 0, above / (F.sqrt(spread.cast("double") / 12.0) * length))


def local_keys(notes: DataFrame, by: str, weight: Column | None = None) -> DataFrame:
    """(entity_id, <by>, key, score, second, margin): for each group of notes (pitch) the key, of twelve major and twelve minor ones, whose profile correlates best with the weights
    of its pitch classes, the runner-up and the lead. Of equals the first, majors first, counts; groups whose pitch classes weigh the same have none."""
    amount = F.lit(1) if weight is None else weight
    sums = notes.groupBy(ENTITY, by).agg(*[F.sum(F.when(F.pmod(F.col("pitch"), F.lit(12)) == i, amount).otherwise(0)).cast("long").alias(f"_{i}") for i in range(12)])
    scores = []
    for mode, profile in (("major", MAJOR_PROFILE), ("minor", MINOR_PROFILE)):
        for tonic in range(12):
            counts = [F.col(f"_{(tonic + i) % 12}") for i in range(12)]
            scores.append(F.struct((-F.round(_correlation(counts, profile), 9)).alias("down"), F.lit(len(scores)).alias("place"), F.lit(f"{PITCH_CLASSES[tonic]} {mode}").alias("key")))
    ranked = sums.withColumn("_r", F.array_sort(F.filter(F.array(*scores), lambda s: s["down"].isNotNull()))).where(F.size("_r") > 0)
    top, second = F.get("_r", F.lit(0)), F.get("_r", F.lit(1))
    return ranked.select(ENTITY, by, top["key"].alias("key"), (-top["down"]).alias("score"), second["key"].alias("second"), F.round(second["down"] - top["down"], 9).alias("margin"))


def gram_sums(rows: DataFrame, vector: str, size: int) -> DataFrame:
    """(i, j, total, n) summed over all rows: products of components, and their sums at j = -1. A task gives its own sums only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
                gram, total, n = gram + x.T @ x, total + x.sum(axis=0), n + len(x)
        if n:
            i, j = np.indices((size, size + 1))
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array((j.ravel() - 1).astype(np.int32)), pa.array(np.column_stack([total, gram]).ravel()), pa.array(np.full(i.size, n))], names=["i", "j", "total", "n"])

    return rows.select(vector).mapInArrow(run, "i int, j int, total double, n long").groupBy("i", "j").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def principal_axes(rows: DataFrame, vector: str, size: int, axes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, the ``axes`` directions of most variance (as rows, each with its largest component positive) and their variances. Rows without a vector
    of this size take no part. Products are summed where the rows lie; size squared numbers reach the driver."""
    used = rows.where(F.size(vector) == size)
    mean, gram, n = np.zeros(size), np.zeros((size, size)), 0
    for r in gram_sums(used, vector, size).collect():
        n = r.n
        if r.j < 0:
            mean[r.i] = r.total
        else:
            gram[r.i, r.j] = r.total
    mean, gram = mean / max(1, n), gram / max(1, n)
    values, vectors = np.linalg.eigh(gram - np.outer(mean, mean))
    top = vectors[:, ::-1][:, :axes].T
    top = top * np.sign(top[np.arange(len(top)), np.abs(top).argmax(axis=1)])[:, None]
    return mean, top, values[::-1][:axes]


def channels(rows: DataFrame, vector: str, mean: np.ndarray, axes: np.ndarray, name: str = "channels") -> DataFrame:
    """rows with their projections on the axes, an array; null where the vector is not of the axes' size."""
    moved = F.zip_with(vector, F.array(*[F.lit(float(m)) for m in mean]), lambda x, m: x - m)
    dot = lambda axis: F.aggregate(F.zip_with(moved, F.array(*[F.lit(float(a)) for a in axis]), lambda x, a: x * a), F.lit(0.0), lambda s, v: s + v)
    return rows.withColumn(name, F.when(F.size(vector) == len(mean), F.array(*[dot(axis) for axis in axes])))


def drift(rows: DataFrame, by: str, along: str, name: str = "channels") -> DataFrame:
    """rows with ``drift``: the distance of a row's channels from those of the row before in its group; 0 in the first, null where either has none."""
    w = Window.partitionBy(by).orderBy(along)
    gaps = F.zip_with(name, F.lag(name).over(w), lambda a, b: (a - b) * (a - b))
    far = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v))
    return rows.withColumn("drift", F.when(F.row_number().over(w) == 1, F.when(F.col(name).isNotNull(), 0.0)).otherwise(far))
