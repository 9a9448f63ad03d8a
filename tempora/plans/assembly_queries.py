"""Queries of section assembly, over groups of bars, beats and onsets made from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import section_assembly
from .registry import HOUR, query
from .section_queries import BARS, bars_of, sections_from
from .timeline_queries import E, rows_of

DAY = 24 * HOUR
VECTOR = ["v1", "v2", "v3"]
REACH, UNIT = 4, 100.0


def beats_with_novelty(spark, sf_dir):
    rows, e, k = rows_of(spark, sf_dir), F.col("energy"), F.coalesce("k", F.lit(0)).cast("long")
    made = rows.select(E, "event_id", "idx", "t", "label", k.alias("k"), (e % 100).alias("v1"), (k % 90).alias("v2"), ((e * 3 + k) % 70).alias("v3"), (e % 97).alias("energy"), ((e * 7 + k) % 89).alias("onset"), ((e + k * 5) % 83).alias("flux"))
    return section_assembly.novelty(made, VECTOR, reach=REACH, unit=UNIT)


def _sums(c: str) -> str:
    return f"sum({c}) OVER back AS l_{c}, sum({c}) OVER ahead AS r_{c}"


_ALL = [*VECTOR, "energy", "onset", "flux"]
_DOT = lambda a, b: " + ".join(f"{a}_{v} * {b}_{v}" for v in VECTOR)
NOVELTY = f"""nb AS (SELECT entity_id, event_id, idx, t, label, coalesce(k, 0) AS k, energy % 100 AS v1, coalesce(k, 0) % 90 AS v2, (energy * 3 + coalesce(k, 0)) % 70 AS v3, energy % 97 AS energy, (energy * 7 + coalesce(k, 0)) % 89 AS onset, (energy + coalesce(k, 0) * 5) % 83 AS flux FROM tl),
nw AS (SELECT *, {', '.join(map(_sums, _ALL))}, count(*) OVER back AS l_n, count(*) OVER ahead AS r_n FROM nb WINDOW back AS (PARTITION BY entity_id ORDER BY idx ROWS BETWEEN {REACH} PRECEDING AND 1 PRECEDING), ahead AS (PARTITION BY entity_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND {REACH - 1} FOLLOWING)),
beats AS (SELECT entity_id, event_id, idx, t, label, k, CASE WHEN l_n = {REACH} AND r_n = {REACH} THEN round(
  sqrt(({' + '.join(f'(r_{v} - l_{v}) * (r_{v} - l_{v})' for v in VECTOR)})::DOUBLE) / {REACH * UNIT}::DOUBLE
  + (1 - CASE WHEN ({_DOT('l', 'l')})::DOUBLE * ({_DOT('r', 'r')})::DOUBLE > 0 THEN ({_DOT('l', 'r')})::DOUBLE / sqrt(({_DOT('l', 'l')})::DOUBLE * ({_DOT('r', 'r')})::DOUBLE) ELSE 1 END) * 0.75::DOUBLE
  + {' + '.join(f'abs(r_{c} - l_{c}) / {REACH * UNIT}::DOUBLE * {w}::DOUBLE' for c, w in (('energy', 0.6), ('onset', 0.35), ('flux', 0.25)))}, 9) END AS contrast FROM nw)"""


@query("boundary_novelty", f"WITH {BARS}, {NOVELTY} SELECT event_id, contrast FROM beats")
def boundary_novelty(spark, sf_dir):
    return beats_with_novelty(spark, sf_dir).select("event_id", "contrast")


def _near(name: str, source: str, time: str, grid: str, pick: str, order: str) -> str:
    """The row of a grid nearest in time to each section."""
    return f"{name} AS (SELECT s.entity_id, s.idx, arg_min({pick}, row(abs(s.{time} - g.t), {order})) AS got FROM {source} s JOIN {grid} g ON g.entity_id = s.entity_id WHERE s.{time} IS NOT NULL GROUP BY 1, 2)"


@query(
    "assembled_sections",
    f"""WITH RECURSIVE {BARS}, {NOVELTY}, barst AS (SELECT entity_id, start_t AS t FROM bars),
gr AS (SELECT entity_id, section + 1 AS idx, start_t + energy % 9 * {2 * HOUR} AS start_t, end_t, section % 7 = 3 OR entity_id % 5 = 0 AS kept, 'part' AS label, energy, repetition, onset FROM sec),
{_near('sn', 'gr', 'start_t', 'barst', 'g.t', '-g.t')}, g1 AS (SELECT gr.*, got AS snapped FROM gr JOIN sn USING (entity_id, idx)),
g2 AS (SELECT * FROM g1 WHERE idx > 1 AND NOT kept), {_near('cb', 'g2', 'snapped', 'beats', 'g.idx', '-g.t')},
st AS (SELECT cb.entity_id, cb.idx, got, d AS step, contrast - 0.12::DOUBLE * abs(d) AS score, b.t FROM cb, range(-4, 5) AS r(d), beats b WHERE b.entity_id = cb.entity_id AND b.idx = got + d AND contrast IS NOT NULL),
bst AS (SELECT entity_id, idx, arg_max(row(step, t), row(score, -abs(step), step)) AS best, max(score) AS top, max(CASE WHEN step = 0 THEN score END) AS own FROM st GROUP BY 1, 2),
rf AS (SELECT g2.entity_id, g2.idx, CASE WHEN best[1] <> 0 AND (own IS NULL OR top >= own + 0.03::DOUBLE) THEN best[2] ELSE snapped END AS refined FROM g2 LEFT JOIN bst USING (entity_id, idx)),
gaps AS (SELECT entity_id, lead(t) OVER (PARTITION BY entity_id ORDER BY idx) - t AS gap, count(*) OVER (PARTITION BY entity_id) AS n FROM tl),
iv AS (SELECT entity_id, list(gap ORDER BY gap)[least(any_value(n) // 2, any_value(n) - 2) + 1] AS gap FROM gaps WHERE gap IS NOT NULL GROUP BY 1),
pk AS (SELECT entity_id, t + k % 5 * {HOUR} AS t FROM beats WHERE label = 'purchase' AND k / 100::DOUBLE >= 0.35::DOUBLE),
g3 AS (SELECT g1.*, refined, coalesce(gap, 500000) * 2 AS reach FROM g1 LEFT JOIN rf USING (entity_id, idx) LEFT JOIN iv USING (entity_id)),
{_near('oa', 'g3', 'refined', 'pk', 'g.t', 'g.t')}, {_near('ob', 'g3', 'snapped', 'pk', 'g.t', 'g.t')},
of_ AS (SELECT g3.*, CASE WHEN g3.idx > 1 AND abs(oa.got - refined) <= reach THEN oa.got END AS ra, CASE WHEN g3.idx > 1 AND abs(ob.got - snapped) <= reach THEN ob.got END AS sa FROM g3 LEFT JOIN oa USING (entity_id, idx) LEFT JOIN ob USING (entity_id, idx)),
walk AS (SELECT entity_id, idx, snapped AS at_, false AS anchored FROM of_ WHERE idx = 1 UNION ALL
  SELECT o.entity_id, o.idx, CASE WHEN o.refined > w.at_ THEN coalesce(ra, o.refined) ELSE coalesce(sa, snapped) END, CASE WHEN o.refined > w.at_ THEN ra IS NOT NULL ELSE sa IS NOT NULL END FROM walk w JOIN of_ o ON o.entity_id = w.entity_id AND o.idx = w.idx + 1),
fin AS (SELECT entity_id, idx, CASE WHEN idx = 1 THEN 0 ELSE at_ END AS start_t, anchored FROM walk)
SELECT entity_id, idx, 'section-' || lpad(idx::VARCHAR, 3, '0') AS section_id, fin.start_t, coalesce(lead(fin.start_t) OVER (PARTITION BY entity_id ORDER BY idx), of_.end_t) AS end_t, label,
  round(greatest(0.2::DOUBLE, least(0.99::DOUBLE, 0.35::DOUBLE + energy / 1000::DOUBLE * 0.25::DOUBLE + repetition / 1000::DOUBLE * 0.25::DOUBLE + onset / 1000::DOUBLE * 0.15::DOUBLE)) + 1e-9::DOUBLE, 6) AS confidence, anchored AS onset_anchored
FROM fin JOIN of_ USING (entity_id, idx)""",
)
def assembled_sections(spark, sf_dir):
    bars, beats = bars_of(spark, sf_dir), beats_with_novelty(spark, sf_dir)
    share = lambda c: (F.col(c) / F.lit(1000.0)).alias(c)
    groups = sections_from(bars).select(E, (F.col("section") + 1).alias("idx"), (F.col("start_t") + F.col("energy") % 9 * (2 * HOUR)).alias("start_t"), "end_t", (F.col("section") % 7 == 3).alias("preserve_start"), F.lit("part").alias("label"), share("energy"), share("repetition"), share("onset"))
    peaks = beats.where("label = 'purchase'").select(E, (F.col("t") + F.col("k") % 5 * HOUR).alias("t"), (F.col("k") / F.lit(100.0)).alias("strength"))
    return section_assembly.assemble(groups, bars, beats, peaks, F.col(E) % 5 == 0)
