"""Aggregates and features of timelines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import artifact
from .windows import ENTITY

#: Rows of a group that one task holds.
BLOCK_ROWS = 2048


def dominant(rows: DataFrame, by: list[str], label: str = "label", weight: str = "energy") -> DataFrame:
    """The most frequent label of each group, then that of larger weight, then the first by name; its
    count and weight."""
    counts = rows.groupBy(ENTITY, *by, label).agg(F.count("*").alias("n"), F.sum(weight).alias("w"))
    rank = Window.partitionBy(ENTITY, *by).orderBy(F.desc("n"), F.desc("w"), label)
    return counts.withColumn("_r", F.row_number().over(rank)).where("_r = 1").select(ENTITY, *by, label, "n", "w")


def most_common(rows: DataFrame, by: list[str], label: str = "label") -> DataFrame:
    """The most frequent label of each group; of equals the one seen first."""
    counts = rows.groupBy(ENTITY, *by, label).agg(F.count("*").alias("n"), F.min("idx").alias("first_idx"))
    return counts.groupBy(ENTITY, *by).agg(F.max_by(F.col(label), F.struct("n", -F.col("first_idx"))).alias(label), F.max("n").alias("n"))


def statistics(rows: DataFrame, x: str) -> DataFrame:
    """Count, mean, population and sample deviation, least and largest of integer values, from exact sums."""
    n, s, q = F.count(x), F.sum(x), F.sum(F.col(x) * F.col(x))
    spread = F.sqrt((n * q - s * s).cast("double"))
    return rows.groupBy(ENTITY).agg(
        n.alias("n"), (s / n).alias("mean"), (spread / n).alias("deviation"), F.when(n > 1, spread / F.sqrt((n * (n - 1)).cast("double"))).alias("sample_deviation"), F.min(x).alias("low"), F.max(x).alias("high")
    )


def levels(rows: DataFrame, x: str, low: float = 1 / 3, high: float = 2 / 3) -> DataFrame:
    """rows with ``level``: high from the upper quantile, medium from the lower, else low."""
    q = rows.groupBy(ENTITY).agg(F.percentile(x, F.array(F.lit(low), F.lit(high))).alias("_q"))
    return rows.join(q, ENTITY).withColumn("level", F.when(F.col(x) >= F.col("_q")[1], "high").when(F.col(x) >= F.col("_q")[0], "medium").otherwise("low")).drop("_q")


def trends(rows: DataFrame, by: list[str], x: str, rise: int) -> DataFrame:
    """Trend of the ordered values of each group: build or release if the mean of the last third is
    that much above or below the first third's, plateau if the spread is small, else wave."""
    w = Window.partitionBy(ENTITY, *by)
    placed = rows.withColumns({"_up": F.row_number().over(w.orderBy("idx")), "_down": F.row_number().over(w.orderBy(F.desc("idx")))})
    third = F.greatest(F.floor((F.col("_up") + F.col("_down") - 1) / 3), F.lit(1))
    part = lambda rank: F.coalesce(F.sum(F.when(F.col(rank) <= third, F.col(x))), F.lit(0))
    g = placed.groupBy(ENTITY, *by).agg(F.count("*").alias("n"), (part("_down") - part("_up")).alias("_change"), (F.max(x) - F.min(x)).alias("_spread"))
    bound = F.lit(rise) * F.greatest(F.floor(F.col("n") / 3), F.lit(1))
    label = F.when(F.col("_change") >= bound, "build").when(F.col("_change") <= -bound, "release").when(F.col("_spread") <= rise, "plateau").otherwise("wave")
    return g.select(ENTITY, *by, F.col("n").cast("int").alias("n"), label.alias("trend"))


def lines(tokens: DataFrame, line: str, text: str, by: str = ENTITY) -> DataFrame:
    """Tokens of a line joined in order of start, with its start, end and count; tokens without a
    line number are left out."""
    good = tokens.where(F.expr(f"try_cast(`{line}` as int)").isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("start_t", F.col(text).alias("_x"))))
    return good.groupBy(by, line).agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.count("*").alias("n"), F.array_join(F.transform(ordered, lambda r: r["_x"]), " ").alias("line_text"))


def precision_recall(rows: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """Counts, precision, recall and F1 of a guess over all rows, as one row."""
    counts = rows.agg(F.count_if(truth & guess).alias("tp"), F.count_if(~truth & guess).alias("fp"), F.count_if(truth & ~guess).alias("fn"))
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return counts.withColumns({"precision": F.coalesce(p, F.lit(0.0)), "recall": F.coalesce(r, F.lit(0.0)), "f1": F.coalesce(F.try_divide(F.col("tp") * 2.0, F.col("tp") * 2 + F.col("fp") + F.col("fn")), F.lit(0.0))})


def validation_split(names: DataFrame, name: str = ENTITY, share: float = 0.2) -> DataFrame:
    """The last share of the sorted names, rounded up, validates; at least one on each side."""
    n = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # ranked in ranges of names, plus what lies in the ranges before: no task sees all names
    dealt = artifact(names.repartitionByRange(n, F.desc(name)).withColumn("_part", F.spark_partition_id()), "split-names")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over as many rows as there are ranges
    offsets = sizes.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"), F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"))
    ranked = dealt.join(F.broadcast(offsets), F.col("_part") == F.col("_of")).withColumn("_r", F.col("_offset") + F.row_number().over(Window.partitionBy("_part").orderBy(F.desc(name))))
    held = F.greatest(F.lit(1), F.least(F.ceil(F.col("_n") * F.lit(share)), F.col("_n") - 1))
    return ranked.withColumn("split", F.when(F.col("_r") <= held, "validation").otherwise("train")).drop("_r", "_n", "_part", "_of", "_offset")


def band_sums(vectors: DataFrame, vector: str, edges: list[int]) -> DataFrame:
    """vectors with ``bands``: sums of the components in each range of places, the last closed."""
    bands = [F.aggregate(F.slice(vector, a + 1, b - a), F.lit(0.0), lambda s, v: s + v.cast("double")) for a, b in zip(edges, edges[1:])]
    return vectors.withColumn("bands", F.array(*bands))


def closest_in_group(vectors: DataFrame, by: str, key: str, vector: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Largest dot product of each vector with another row of its group, and that one's key, the least
    on a tie (-1 and NaN where there is none). Groups are dealt into blocks of rows and of queries by a
    hash, and each pair of blocks is a task's: no group is held whole."""
    names = {by: "_by", key: "_key", vector: "_vector"}
    rows = vectors.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).groupBy("_by", "_key", "_vector").agg(F.count("*").alias("_n")).withColumn("_mark", F.xxhash64("_vector"))
    sizes = rows.groupBy("_by").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("_blocks")).withColumnRenamed("_by", "_of")
    dealt = rows.join(sizes, F.col("_by").eqNullSafe(F.col("_of"))).withColumn("_own", F.pmod(F.xxhash64("_key", "_mark"), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    columns = ["_by", "_key", "_vector", "_n", "_mark"]
    left = dealt.select(*columns, F.col("_own").alias("_r"), F.col("_other").alias("_q")).groupBy("_by", "_r", "_q")
    right = dealt.select(*columns, "_other", "_own").toDF(*columns, "_r", "_q").groupBy("_by", "_r", "_q")  # named anew, as both sides are one table

    def best(base: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        other, score = np.full(len(asked), None, dtype=object), np.full(len(asked), None, dtype=object)
        if len(base) and len(asked):
            base = base.sort_values("_key")
            rows, ids = np.stack(base["_vector"].to_numpy()).astype(float), base["_key"].to_numpy()
            queries = np.stack(asked["_vector"].to_numpy()).astype(float)
            # a row that stands there once is not its own neighbour
            place = {(k, m): i for i, (k, m, n) in enumerate(zip(ids, base["_mark"], base["_n"])) if n == 1}
            own = np.array([place.get(pair, -1) for pair in zip(asked["_key"], asked["_mark"])])
            for at in range(0, len(queries), 256):
                part = queries[at : at + 256] @ rows.T
                mine = own[at : at + 256]
                part[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf
                line = part.max(axis=1)
                # sums in component order, so that equal vectors tie in whatever block they are
                q, d = np.nonzero((part >= (line - 1e-9 * (1 + np.abs(line)))[:, None]) & (part > -np.inf))
                exact = np.zeros(len(q))
                for c in range(rows.shape[1]):
                    exact += queries[at + q, c] * rows[d, c]
                order = np.lexsort((d, -exact, q))
                q, d, exact = q[order], d[order], exact[order]
                first = np.flatnonzero(np.diff(q, prepend=-1))
                other[at + q[first]], score[at + q[first]] = ids[d[first]], exact[first]
        return pd.DataFrame({"_by": asked["_by"], "_key": asked["_key"], "_mark": asked["_mark"], "_n": asked["_n"], "_other": pd.array(other, dtype="Int64"), "_score": pd.array(score, dtype="Float64")})

    met = left.cogroup(right).applyInPandas(best, f"_by {vectors.schema[by].dataType.simpleString()}, _key long, _mark long, _n long, _other long, _score double")
    least = F.min(F.when(F.col("_score").isNotNull(), F.struct((-F.col("_score")).alias("s"), F.col("_other").alias("o")))).alias("_least")
    found = met.groupBy("_by", "_key", "_mark", "_n").agg(least).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    return found.select(F.col("_by").alias(by), F.col("_key").alias(key), F.coalesce("_least.o", F.lit(-1).cast("long")).alias("other"), F.coalesce(-F.col("_least.s"), F.lit(float("nan"))).alias("score"))


def energy_clusters(rows: DataFrame, values: list[str], k: int = 3, seed: int = 42) -> DataFrame:
    """k-means clusters of each entity's rows, ranked 0 to k-1 by their first value's mean; entities of
    at most ten rows are all of the highest rank."""

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[values].to_numpy(dtype=float)
        if len(x) <= 10:
            return pd.DataFrame({ENTITY: pdf[ENTITY], "event_id": pdf["event_id"], "cluster": k - 1})
        scale = x.std(axis=0)
        z = (x - x.mean(axis=0)) / np.where(scale > 0, scale, 1)
        centres = z[np.random.default_rng(seed).choice(len(z), k, replace=False)]
        for _ in range(50):
            own = ((z[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            new = np.stack([z[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(k)])
            if np.allclose(new, centres):
                break
            centres = new
        rank = centres[:, 0].argsort().argsort()
        return pd.DataFrame({ENTITY: pdf[ENTITY], "event_id": pdf["event_id"], "cluster": rank[own]})

    return rows.groupBy(ENTITY).applyInPandas(cluster, f"{ENTITY} long, event_id long, cluster int")
