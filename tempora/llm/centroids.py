"""Centroid clustering with partial-distance search, in whole numbers.

Every component x becomes floor(scale * x). Lloyd rounds assign each vector to its nearest centroid and move
centroids to floored means. A vector's squared difference from a centroid is added up over a few dimensions at
a time, those of high variance first, and the centroid is abandoned once the part is strictly above the best
distance known, so that ties are never lost; survivors finish all dimensions. The search starts from the
centroid nearest over the first dimensions, which is finished at once.

Tasks give sums by cluster and position, a fixed number whatever their rows, so a cluster that holds most of the
rows is no hot key. The driver holds the centroids, and no vector.

Defined cases: rows whose vector is null, of another length, or holds a null or non-finite component are left
out. Components beyond ``magnitude_limit`` in size (two million before scaling, for 64 components) count as that
limit, so that distances fit a long; sums of distances end at the largest long. Repeated rows are rows of their own. Of rows with one id, those of
smaller components start first; a null id is hashed as an empty one. Fewer vectors than centroids give as many
centroids as vectors. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, materialise
from .integer_vectors import GroupSums, floor_means, floored, rows_of, within_limit

CENTROIDS, ROUNDS, SCALE, LENGTH = 16, 3, 64, 64
SEED = "1:"
#: Dimensions added up before centroids are abandoned.
STEP = 8
LARGEST = (1 << 63) - 1


def nearest_centroids(rows: np.ndarray, centroids: np.ndarray, order: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each row, the smaller number on ties; and the
    number of squared differences that were added up. order: the dimensions, high variance first."""
    x, c = rows[:, order], centroids[:, order]
    length = x.shape[1]
    head = np.stack([((x[:, :step] - one[:step]) ** 2).sum(axis=1) for one in c], axis=1)
    start = head.argmin(axis=1)
    which, best = start.copy(), ((x - c[start]) ** 2).sum(axis=1)
    added = head.size * min(step, length) + len(x) * length
    for j in range(len(c)):
        alive = np.flatnonzero((start != j) & (head[:, j] <= best))
        part = head[alive, j]
        for at in range(step, length, step):
            part = part + ((x[alive, at : at + step] - c[j, at : at + step]) ** 2).sum(axis=1)
            added += len(alive) * len(c[j, at : at + step])
            left = part <= best[alive]
            alive, part = alive[left], part[left]
        nearer = (part < best[alive]) | ((part == best[alive]) & (j < which[alive]))
        which[alive[nearer]], best[alive[nearer]] = j, part[nearer]
    return which, best, added


def variance_order(vectors: DataFrame, length: int) -> np.ndarray:
    """Dimensions by descending variance over all rows of vectors (whole)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(length), np.zeros(length)
        for batch in batches:
            rows = rows_of(batch.column(0)).astype(float) if batch.num_rows else np.zeros((0, length))
            n, total, square = n + len(rows), total + rows.sum(axis=0), square + (rows**2).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length, dtype=np.int32)), pa.array(total), pa.array(square), pa.array(np.full(length, n))], names=["position", "total", "square", "n"])

    summed = vectors.select("whole").mapInArrow(run, "position int, total double, square double, n long").groupBy("position").agg(F.sum("total").alias("t"), F.sum("square").alias("s"), F.sum("n").alias("n"))
    spread = {r.position: r.s / max(1, r.n) - (r.t / max(1, r.n)) ** 2 for r in summed.collect()}
    return np.array(sorted(range(length), key=lambda i: (-spread.get(i, 0.0), i)), dtype=int)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray, order: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = GroupSums(*centroids.shape)
        for batch in batches:
            if batch.num_rows:
                rows = rows_of(batch.column(0))
                sums.add(rows, nearest_centroids(rows, centroids, order)[0])
        yield from sums.batches()

    return vectors.select("whole").mapInArrow(run, GroupSums.SCHEMA)


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, length: int = LENGTH, key: str = "vec_id", vector: str = "embedding", seed: str = SEED) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of the length."""
    spark = vectors.sparkSession
    whole = floored(vectors, scale, vector, key).where(F.size("whole") == length).withColumn("whole", within_limit(F.col("whole"), length))
    whole = materialise(whole.withColumnRenamed(key, "_key"), "cluster-vectors")
    kind = whole.schema["_key"].dataType.simpleString()
    ddl = f"_key {kind}, cluster int, distance long"
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("_key").cast("string"), F.lit(""))).cast("binary"), 256)
    first = whole.select(hashed.alias("h"), "whole").orderBy("h", "whole").limit(centroids).collect()
    out = F.col("_key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    if not first:
        return spark.createDataFrame([], f"{ddl}, cluster_inertia long, inertia long, centroid_sha256 string").select(*out)
    at = np.array([r.whole for r in sorted(first, key=lambda r: (r.h, r.whole))], dtype=np.int64).reshape(len(first), length)
    order = variance_order(whole, length)
    for _ in range(rounds):
        moved = floor_means(cluster_sums(whole, at, order), at)
        if (moved == at).all():
            break
        at = moved

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                which, best, _ = nearest_centroids(rows_of(batch.column(1)), at, order)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(which.astype(np.int32)), pa.array(best)], names=["_key", "cluster", "distance"])

    found = materialise(whole.select("_key", "whole").mapInArrow(run, ddl), "cluster-found")
    forget(whole)
    parts = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # one row a centroid
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in at.tolist()]
    facts = [(j, min(parts[j], LARGEST), min(sum(parts.values()), LARGEST), digests[j]) for j in sorted(parts)]
    table = spark.createDataFrame(facts, "_of int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), F.col("cluster") == F.col("_of")).select(*out)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def lloyd_sql() -> str:
    """The rounds written out as common table expressions."""
    distance = "CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [
        f"""kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {LENGTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {LENGTH})""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('{SEED}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {CENTROIDS}))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS (SELECT vec_id, k.v, c, {distance} AS d FROM kept k CROSS JOIN c{r} c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)")
        if r < ROUNDS:
            mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
            steps.append(f"""m{r} AS (SELECT c, list({mean} ORDER BY i) AS v FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {LENGTH + 1}) AS p(i) GROUP BY c, i) GROUP BY c)""")
            steps.append(f"c{r + 1} AS (SELECT c{r}.c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c)")
    last = f"""SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN c{ROUNDS} c ON a.c = c.c"""
    return "WITH " + ",\n".join(steps) + "\n" + last


OP11_SQL = lloyd_sql()
