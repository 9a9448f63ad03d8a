"""Approximate nearest neighbours by inner product over learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts with few edges between them. A
small classifier learns the part of a vector. Every row is indexed under its most probable part;
a query goes to its several most probable parts, where all rows are ranked by exact scores. The
number of parts probed is the least that reaches ``TARGET_RECALL`` on queries of the sample, so
data without structure, whose neighbours no partition holds together, are probed widely.

Parts are dealt out in blocks of rows, and the queries of a part in blocks too, so one part may
hold a third of all rows. In a block equal vectors are ranked once, with their least ids.

The sample is at most about ``SAMPLE_ROWS`` vectors, spread by a hash of the id, and is fitted on
the driver; of all other rows only their number for each part gets there.

Defined cases: vectors that are null, empty, zero, hold a null or non-finite component, or have
another length than most take no part, as queries or as candidates; nor do rows without an id.
Equal scores are ordered by id. Rows that repeat a query's id are its own and not candidates; a
query id that occurs twice is one query, with the least of its vectors. Fewer candidates than
asked for are all returned. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, need_columns

NEIGHBOURS = 20
#: Vectors in the sample that the partition is learned from, and of those, queries that set the
#: number of probes.
SAMPLE_ROWS, PROBE_ROWS = 12_000, 600
#: Rows meant for one part, and the least and most parts. Beyond MAX_PARTS times PART_ROWS rows (8.4 million) parts hold more rows, in more
#: blocks; only the work of a query grows then, with the table, and no row is left out.
PART_ROWS, MIN_PARTS, MAX_PARTS = 8192, 8, 1024
TARGET_RECALL = 0.96
#: Edges of a vector in the graph, rounds of refining, and how much fuller than the mean a part is.
EDGES, ROUNDS, SLACK = 10, 12, 1.1
#: Rows and queries that meet in one group.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    chosen = need_columns(vectors, key, vector).select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    good = chosen.where("vec_id is not null and embedding is not null").where(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))
    length = good.agg(F.mode(F.size("embedding"), True)).first()[0]
    return good.where(F.size("embedding") == (length or 0))


def neighbour_lists(rows: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Places of the k rows of largest inner product with each query; own: the query's own place."""
    out = np.zeros((len(queries), min(k, len(rows))), dtype=np.int64)
    for at in range(0, len(queries), 512):
        scores = queries[at : at + 512] @ rows.T
        if own is not None:
            scores[np.arange(len(scores)), own[at : at + 512]] = -np.inf
        out[at : at + 512] = np.argpartition(-scores, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(rows: np.ndarray, edges: np.ndarray, parts: int, rounds: int = ROUNDS, slack: float = SLACK, seed: int = 1) -> np.ndarray:
    """A part for each row: seeded by balanced assignment to random rows, then refined by moving
    rows to the part that holds most of their neighbours, as long as it has room."""
    rng = np.random.default_rng(seed)
    n, room = len(rows), math.ceil(slack * len(rows) / parts)
    centres = rows[rng.choice(n, parts, replace=n < parts)]
    part = np.full(n, -1)
    for _ in range(5):
        wish = np.argsort(-(rows @ centres.T), axis=1)
        part[:], sizes = -1, np.zeros(parts, dtype=int)
        for rank in range(parts):
            for i in np.flatnonzero(part < 0):
                p = wish[i, rank]
                if sizes[p] < room:
                    part[i] = p
                    sizes[p] += 1
            if (part >= 0).all():
                break
        centres = np.stack([rows[part == p].mean(axis=0) if (part == p).any() else centres[p] for p in range(parts)])
    both = np.concatenate([np.column_stack([np.repeat(np.arange(n), edges.shape[1]), edges.ravel()]), np.column_stack([edges.ravel(), np.repeat(np.arange(n), edges.shape[1])])])
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        near = np.zeros((n, parts))
        np.add.at(near, (both[:, 0], part[both[:, 1]]), 1)
        best = near.argmax(axis=1)
        gain = near[np.arange(n), best] - near[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < n // 500:
            break
    return part


@dataclass
class Router:
    """A linear softmax classifier over parts, and how many parts a query is sent to."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def ranked(self, rows: np.ndarray) -> np.ndarray:
        return np.argsort(-(rows @ self.weights + self.bias), axis=1, kind="stable")

    @staticmethod
    def fit(rows: np.ndarray, part: np.ndarray, parts: int, steps: int = 150) -> Router:
        n, m = rows.shape
        truth = np.zeros((n, parts))
        truth[np.arange(n), part] = 1
        w, b = np.zeros((m, parts)), np.zeros(parts)
        moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
        for t in range(1, steps + 1):
            z = rows @ w + b
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True) - truth
            for value, grad, k in ((w, rows.T @ error / n + 1e-5 * w, 0), (b, error.mean(axis=0), 2)):
                moments[k] = 0.9 * moments[k] + 0.1 * grad
                moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * grad**2
                value -= 0.3 * (moments[k] / (1 - 0.9**t)) / (np.sqrt(moments[k + 1] / (1 - 0.99**t)) + 1e-9)
        return Router(w, b, parts)


def learn_router(sample: np.ndarray, total: int, target: float = TARGET_RECALL, k: int = NEIGHBOURS) -> Router:
    """Partition the sample's graph, fit the classifier, and set the probes from the sample."""
    parts = min(MAX_PARTS, max(MIN_PARTS, round(total / PART_ROWS)), max(1, len(sample) // 8))
    sample = np.unique(sample, axis=0)  # copies add nothing to the graph
    scaled = sample / np.linalg.norm(sample, axis=1).mean()
    everyone = np.arange(len(scaled))
    if parts == 1 or len(scaled) < 4 * parts:
        return Router(np.zeros((sample.shape[1], 1)), np.zeros(1), 1)
    edges = neighbour_lists(scaled, scaled, min(EDGES, len(scaled) - 1), everyone)
    router = Router.fit(scaled, balanced_parts(scaled, edges, parts), parts)
    router.weights /= np.linalg.norm(sample, axis=1).mean()
    tried = np.random.default_rng(2).choice(len(sample), min(PROBE_ROWS, len(sample)), replace=False)
    near = neighbour_lists(sample, sample[tried], min(k, len(sample) - 1), tried)
    home = router.ranked(sample)[:, 0]
    order = router.ranked(sample[tried])
    rank = np.argsort(order, axis=1)
    needed = rank[np.arange(len(tried))[:, None], home[near]] + 1
    found = np.array([(needed <= m).mean() for m in range(1, parts + 1)])
    router.probes = int(np.argmax(found >= target)) + 1
    return router


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def routed(vectors: DataFrame, router: Router, probes: int) -> DataFrame:
    """vectors (vec_id, embedding) once for each of their ``probes`` most probable parts."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = router.ranked(matrix(batch.column(1)))[:, :probes]
            took = pa.array(np.repeat(np.arange(batch.num_rows), parts.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array(parts.ravel().astype(np.int32)), batch.column(0).take(took), batch.column(1).take(took)], names=["part", "vec_id", "embedding"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "part int, vec_id long, embedding array<double>")


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def rank_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k nearest rows of a block for each of its queries; scores are sums in component order."""

    def distinct(ids: np.ndarray, rows: np.ndarray, most: int | None) -> tuple[np.ndarray, ...]:
        """Distinct vectors; and their distinct ids in order of vector and id, at most ``most`` of
        each vector, with the number of their vector and how often they stand there."""
        unique, number = np.unique(rows, axis=0, return_inverse=True)
        number = number.ravel()
        order = np.lexsort((ids, number))
        ids, number = ids[order], number[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(number) != 0) | (np.diff(ids) != 0)]))
        times = np.diff(np.append(new, len(ids)))
        ids, number = ids[new], number[new]
        if most is not None:
            rank = np.arange(len(number)) - np.searchsorted(number, number)
            ids, number, times = ids[rank < most], number[rank < most], times[rank < most]
        return unique, ids, number, times

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return FOUND.empty_table()
        base, base_ids, base_of, base_times = distinct(rows.column("vec_id").to_numpy(), matrix(rows.column("embedding")), k + 1)
        asked, asked_ids, asked_of, _ = distinct(queries.column("vec_id").to_numpy(), matrix(queries.column("embedding")), None)
        starts = np.searchsorted(base_of, np.arange(len(base) + 1))
        # vectors and places that a query's own id takes up at most
        names, vectors = np.unique(base_ids, return_counts=True)
        places = k + int(vectors[np.isin(names, asked_ids)].max(initial=0))
        out = []
        for at in range(0, len(asked), 256):
            some = asked[at : at + 256]
            scores = some @ base.T
            if len(base) > places:
                line = np.partition(scores, len(base) - places, axis=1)[:, len(base) - places]
                q, d = np.nonzero(scores >= (line - 1e-9 * (1 + np.abs(line)))[:, None])
            else:
                q, d = (x.ravel() for x in np.indices(scores.shape))
            exact = np.zeros(len(q))
            for c in range(base.shape[1]):
                exact += some[q, c] * base[d, c]
            count = starts[d + 1] - starts[d]  # to the ids of each vector
            q, exact = np.repeat(q, count), np.repeat(exact, count)
            spots = np.repeat(starts[d] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            order = np.lexsort((base_ids[spots], -exact, q))
            q, exact, spots = q[order], exact[order], spots[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < places
            q, exact, spots = q[keep], exact[keep], spots[keep]
            bounds = np.searchsorted(q, np.arange(len(some) + 1))
            mine = (asked_of >= at) & (asked_of < at + len(some))
            own, of = asked_ids[mine], asked_of[mine] - at
            count = bounds[of + 1] - bounds[of]
            take = np.repeat(bounds[of] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            line = np.repeat(np.arange(len(own)), count)
            other = base_ids[spots[take]] != own[line]
            take, line = take[other], line[other]
            # repeated rows of another id take a place each
            times = np.minimum(base_times[spots[take]], k)
            take, line = np.repeat(take, times), np.repeat(line, times)
            first = np.arange(len(line)) - np.searchsorted(line, line) < k
            take, line = take[first], line[first]
            out.append((own[line], base_ids[spots[take]], exact[take]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out)], schema=FOUND)

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, key: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS, target: float = TARGET_RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of each row where is_query holds
    (over columns vec_id, embedding), among all rows but its own."""
    spark = vectors.sparkSession
    good = materialise(usable(vectors, key, vector), "ann-vectors")
    total = good.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    spread = F.pmod(F.xxhash64(F.lit("ann"), "vec_id"), F.lit(1 << 30))
    drawn = good.where(spread < int((1 << 30) * min(1.0, sample_rows / total))).select("vec_id", "embedding").toPandas() if total > 1 else None
    rows = np.stack(drawn.sort_values("vec_id")["embedding"].to_numpy()) if drawn is not None and len(drawn) else np.ones((1, len(good.first().embedding)))
    router = learn_router(rows, total, target, k)

    index = materialise(routed(good, router, 1), "ann-index")
    asked = good.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = materialise(routed(asked, router, router.probes), "ann-queries")
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("_rows"))
    askers = asked.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("_queries"))
    grid = F.broadcast(materialise(blocks.join(askers, "part").select(F.col("part").alias("_part"), "_rows", "_queries"), "ann-grid"))  # MAX_PARTS rows at most
    over = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    spot = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    left = index.join(grid, F.col("part") == F.col("_part")).withColumn("_r", spot("_rows")).withColumn("_q", over("_queries"))
    right = asked.join(grid, F.col("part") == F.col("_part")).withColumn("_q", spot("_queries")).withColumn("_r", over("_rows"))
    columns = ["part", "_r", "_q", "vec_id", "embedding"]
    met = left.select(columns).groupBy("part", "_r", "_q").cogroup(right.select(columns).groupBy("part", "_r", "_q"))
    found = met.applyInArrow(rank_block(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 20 == 0)
