"""Queries of curves, over rows made from the events and over the embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import curves
from .feature_queries import beats_of
from .registry import TL, query
from .timeline_queries import E, rows_of

REACH, TAPER, LAGS, AXES = 4, [4, 3, 2, 1], 12, 4
VECTOR = {"v1": "energy % 100", "v2": "(energy * 7 + coalesce(k, 0)) % 90", "v3": "coalesce(k, 0) % 50"}


def _side(v: str, sign: str) -> str:
    return " + ".join(f"{f'lag({v}, {j + 1})' if sign == '-' else (f'lead({v}, {j})' if j else v)} {'OVER w' if sign == '-' or j else ''} * {g}" for j, g in enumerate(TAPER))


@query(
    "novelty_curve",
    f"""WITH {TL}, x AS (SELECT entity_id, event_id, idx, {', '.join(f'{e} AS {v}' for v, e in VECTOR.items())} FROM tl),
s AS (SELECT event_id, {', '.join(f'({_side(v, "+")}) - ({_side(v, "-")}) AS d_{v}' for v in VECTOR)} FROM x WINDOW w AS (PARTITION BY entity_id ORDER BY idx))
SELECT event_id, ({' + '.join(f'd_{v} * d_{v}' for v in VECTOR)}) / {float(sum(TAPER) ** 2)}::DOUBLE AS novelty FROM s""",
)
def novelty_curve(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    return curves.novelty_curve(rows.select(E, "event_id", "idx", *[F.expr(e).cast("long").alias(v) for v, e in VECTOR.items()]), list(VECTOR), REACH, TAPER).select("event_id", "novelty")


_AC = f"""{TL}, x AS (SELECT entity_id, idx, energy % 1000 + CASE WHEN idx % 4 = 1 THEN 500 ELSE 0 END AS x FROM tl), n AS (SELECT entity_id, count(*) AS n, sum(x)::HUGEINT AS s, sum(x * x)::HUGEINT AS q FROM x GROUP BY 1),
p AS (SELECT a.entity_id, b.idx - a.idx AS lag, count(*) AS m, sum(a.x)::HUGEINT AS sx, sum(b.x)::HUGEINT AS sy, sum(a.x * b.x)::HUGEINT AS xy FROM x a JOIN x b ON a.entity_id = b.entity_id AND b.idx BETWEEN a.idx + 1 AND a.idx + {LAGS} GROUP BY 1, 2),
c AS (SELECT entity_id, lag, n, CASE WHEN n * n * q - n * s * s > 0 THEN round((n * n * xy - n * s * (sx + sy) + m * s * s)::DOUBLE / (n * n * q - n * s * s)::DOUBLE, 9) END AS correlation FROM p JOIN n USING (entity_id))"""


def correlations_of(spark, sf_dir):
    rows = rows_of(spark, sf_dir).withColumn("x", F.col("energy") % 1000 + F.when(F.col("idx") % 4 == 1, 500).otherwise(0))
    return curves.autocorrelation(rows, "x", LAGS)


@query("autocorrelation", f"WITH {_AC} SELECT * FROM c")
def autocorrelation(spark, sf_dir):
    return correlations_of(spark, sf_dir)


@query("periods", f"WITH {_AC}, t AS (SELECT *, lag(correlation) OVER w AS b, lead(correlation) OVER w AS a FROM c WINDOW w AS (PARTITION BY entity_id ORDER BY lag)) SELECT entity_id, arg_max(lag, row(correlation, -lag)) AS period, max(correlation) AS strength FROM t WHERE correlation > b AND correlation > a AND correlation >= 0.1::DOUBLE GROUP BY 1")
def periods(spark, sf_dir):
    return curves.periods(correlations_of(spark, sf_dir))


_PROFILES = [(mode, (np.array(p) - np.mean(p)).tolist(), float(np.sqrt(np.square(np.array(p) - np.mean(p)).sum()))) for mode, p in (("major", curves.MAJOR_PROFILE), ("minor", curves.MINOR_PROFILE))]
_SCORES = ", ".join(
    f"{{'down': -round(({' + '.join(f'c{(tonic + i) % 12} * {p!r}::DOUBLE' for i, p in enumerate(centred))}) / (sqrt(spread::DOUBLE / 12) * {length!r}::DOUBLE), 9), 'place': {m * 12 + tonic}, 'key': '{curves.PITCH_CLASSES[tonic]} {mode}'}}"
    for m, (mode, centred, length) in enumerate(_PROFILES)
    for tonic in range(12)
)


@query(
    "local_keys",
    f"""WITH {TL}, s AS (SELECT entity_id, (idx - 1) // 16 AS section, {', '.join(f'sum(CASE WHEN (coalesce(k, 0) + energy) % 12 = {i} THEN 1 + energy % 3 ELSE 0 END)::BIGINT AS c{i}' for i in range(12))} FROM tl GROUP BY 1, 2),
d AS (SELECT *, ({' + '.join(f'c{i} * c{i}' for i in range(12))}) * 12 - ({' + '.join(f'c{i}' for i in range(12))}) * ({' + '.join(f'c{i}' for i in range(12))}) AS spread FROM s), r AS (SELECT entity_id, section, list_sort([{_SCORES}]) AS r FROM d WHERE spread > 0)
SELECT entity_id, section, r[1].key AS key, -r[1].down AS score, r[2].key AS second, round(r[2].down - r[1].down, 9) AS margin FROM r""",
)
def local_keys(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    notes = rows.select(E, F.floor((F.col("idx") - 1) / 16).cast("long").alias("section"), (F.col("k") + F.col("energy")).alias("pitch"), (F.col("energy") % 3 + 1).alias("w"))
    return curves.local_keys(notes, "section", F.col("w"))


@query("channel_drift")
def channel_drift(spark, sf_dir):
    """Drift of the embeddings' channels along each label; no SQL, the axes being eigenvectors; tested against numpy."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    mean, axes, _ = curves.principal_axes(rows, "embedding", 64, AXES)
    placed = curves.channels(rows, "embedding", mean, axes)
    return curves.drift(placed, "label", "vec_id").select("vec_id", "label", F.transform("channels", lambda x: F.round(x, 6)).alias("channels"), F.round("drift", 6).alias("drift"))
