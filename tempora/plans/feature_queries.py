"""Queries of the wide feature row and of the rule candidates, over tracks made from the events."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import beat_features, joins, rule_events, windows
from ..operators.beat_features import FEATURES, Tracks
from ..sources.artifacts import code_of, reusable
from ..sources.tables import artifact
from .registry import HOUR, TL, query
from .timeline_queries import E, rows_of

MINUTE = HOUR // 60
SECOND = MINUTE // 60
DAY = 24 * HOUR


def beats_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of(spark, sf_dir)
    return rows.withColumns({"k": F.coalesce("k", F.lit(0)).cast("long"), "end_t": F.coalesce(F.lead("t").over(windows.order()), F.col("t"))})


def tracks_of(rows: DataFrame) -> Tracks:
    """Tracks with gaps, made of the rows: some beats have no energy, density or stem row."""
    e, k, n = F.col("energy"), F.col("k"), F.col("event_id")
    pick = lambda where, **columns: rows.where(where).select(E, "idx", *[c.alias(x) for x, c in columns.items()])
    section, phrase = F.floor((F.col("idx") - 1) / 8).cast("long"), F.floor((F.col("idx") - 1) / 4).cast("long")
    spans = lambda by, name, df: df.groupBy(E, by.alias(name)).agg(F.min("t").alias("start_t"), F.max("t").alias("end_t"))
    chords = rows.where("idx % 4 = 1").select(E, F.col("t").alias("start_t"), F.coalesce(F.lead("t").over(windows.order()), F.col("t")).alias("end_t"), F.col("label").alias("chord"), (k * 10_000).alias("chord_confidence"))
    return Tracks(
        energy=pick(n % 11 != 0, loudness=e, onset=(e * 7 + k * 131) % 1000, flux=(e * 3 + k * 17) % 1000, centroid=(e + k * 37) % 1000),
        density=pick(n % 13 != 0, note_count=k % 4, density=k % 4 * 250),
        stems=pick(n % 19 != 0, vocals_stem=(e * 5 + k) % 997, drums_stem=(e * 11 + k * 3) % 997, harmonic_stem=(e * 2 + k * 7) % 997, bass_stem=(e + k * 29) % 997),
        sections=spans(section, "section", rows),
        phrases=spans(phrase, "phrase", rows.where(phrase % 3 != 2)),
        chords=chords,
        notes=rows.where("label in ('click', 'view')").select(E, F.when(F.col("label") == "click", "vocals").otherwise("bass").alias("stem"), (F.col("t") + 10 * MINUTE).alias("start_t"), (F.col("t") + (k + 1) * (30 * MINUTE)).alias("end_t")),
        accents=rows.where("label = 'purchase'").select(E, n.alias("accent_id"), (F.col("t") + k * MINUTE).alias("at"), e.alias("intensity")),
    )


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = beats_of(spark, sf_dir)
    beats = rows.select(E, "event_id", "idx", "bar", "beat_in_bar", "t", "end_t")
    return beat_features.beat_rows(beats, tracks_of(rows), DAY)


WIDE = f"""{TL}, en AS (SELECT entity_id, event_id, idx, bar, beat_in_bar, t, label, energy, coalesce(k, 0) AS k, coalesce(next_t, t) AS end_t FROM tl),
mid AS (SELECT *, (t + end_t) // 2 AS m FROM en),
sec AS (SELECT entity_id, (idx - 1) // 8 AS section, min(t) AS s, max(t) AS e FROM en GROUP BY 1, 2),
phr AS (SELECT entity_id, (idx - 1) // 4 AS phrase, min(t) AS s, max(t) AS e FROM en WHERE (idx - 1) // 4 % 3 <> 2 GROUP BY 1, 2),
chords AS (SELECT entity_id, t AS s, label AS chord, k * 10000 AS chord_confidence FROM en WHERE idx % 4 = 1),
s0 AS (SELECT entity_id, max(s) AS at_, max(section) AS section FROM sec GROUP BY 1),
p0 AS (SELECT entity_id, max(s) AS at_, max(phrase) AS phrase FROM phr GROUP BY 1),
s1 AS (SELECT x.entity_id, x.idx, min(section) AS section FROM mid x JOIN sec y ON x.entity_id = y.entity_id AND x.m >= s AND x.m < e GROUP BY 1, 2),
s2 AS (SELECT x.entity_id, x.idx, min(section) AS section FROM mid x JOIN sec y ON x.entity_id = y.entity_id AND x.t >= s AND x.t < e GROUP BY 1, 2),
p1 AS (SELECT x.entity_id, x.idx, min(phrase) AS phrase FROM mid x JOIN phr y ON x.entity_id = y.entity_id AND x.m >= s AND x.m < e GROUP BY 1, 2),
acc AS (SELECT entity_id, event_id AS accent_id, t + k * {MINUTE} AS at_, energy AS intensity FROM en WHERE label = 'purchase'),
a1 AS (SELECT x.entity_id, x.idx, accent_id, intensity, row_number() OVER (PARTITION BY x.entity_id, x.idx ORDER BY at_, accent_id) AS rn FROM en x JOIN acc y ON x.entity_id = y.entity_id AND at_ >= t AND at_ < end_t),
note AS (SELECT entity_id, label, t + {10 * MINUTE} AS s, t + (k + 1) * {30 * MINUTE} AS e FROM en WHERE label IN ('click', 'view')),
n1 AS (SELECT x.entity_id, x.idx, sum(CASE WHEN y.label = 'click' THEN least(end_t, e) - greatest(t, s) END)::BIGINT AS voc, sum(CASE WHEN y.label = 'view' THEN least(end_t, e) - greatest(t, s) END)::BIGINT AS bas FROM en x JOIN note y ON x.entity_id = y.entity_id AND s < end_t AND e > t AND end_t > t GROUP BY 1, 2),
r0 AS (SELECT x.entity_id, x.event_id, x.idx, x.bar, x.beat_in_bar, x.t, x.end_t,
  coalesce(s1.section, CASE WHEN x.m >= s0.at_ THEN s0.section END) AS section, coalesce(s2.section, CASE WHEN x.t >= s0.at_ THEN s0.section END) AS start_section, coalesce(p1.phrase, CASE WHEN x.m >= p0.at_ THEN p0.phrase END) AS phrase,
  ch.chord, ch.chord_confidence,
  CASE WHEN x.event_id % 11 <> 0 THEN energy ELSE 0 END AS loudness, CASE WHEN x.event_id % 11 <> 0 THEN (energy * 7 + k * 131) % 1000 ELSE 0 END AS onset, CASE WHEN x.event_id % 11 <> 0 THEN (energy * 3 + k * 17) % 1000 ELSE 0 END AS flux, CASE WHEN x.event_id % 11 <> 0 THEN (energy + k * 37) % 1000 ELSE 0 END AS centroid,
  CASE WHEN x.event_id % 13 <> 0 THEN k % 4 ELSE 0 END AS note_count, CASE WHEN x.event_id % 13 <> 0 THEN k % 4 * 250 ELSE 0 END AS density,
  CASE WHEN x.event_id % 19 <> 0 THEN (energy * 5 + k) % 997 ELSE 0 END AS vocals_stem, CASE WHEN x.event_id % 19 <> 0 THEN (energy * 11 + k * 3) % 997 ELSE 0 END AS drums_stem, CASE WHEN x.event_id % 19 <> 0 THEN (energy * 2 + k * 7) % 997 ELSE 0 END AS harmonic_stem, CASE WHEN x.event_id % 19 <> 0 THEN (energy + k * 29) % 997 ELSE 0 END AS bass_stem,
  a1.accent_id, coalesce(a1.intensity, 0) AS accent_intensity, least(1000000, coalesce(voc, 0) * 1000000 // greatest(1, end_t - x.t)) AS vocal_presence, least(1000000, coalesce(bas, 0) * 1000000 // greatest(1, end_t - x.t)) AS bass_activation
  FROM mid x ASOF JOIN chords ch ON x.entity_id = ch.entity_id AND x.t >= ch.s LEFT JOIN s0 ON s0.entity_id = x.entity_id LEFT JOIN p0 ON p0.entity_id = x.entity_id LEFT JOIN s1 ON s1.entity_id = x.entity_id AND s1.idx = x.idx LEFT JOIN s2 ON s2.entity_id = x.entity_id AND s2.idx = x.idx LEFT JOIN p1 ON p1.entity_id = x.entity_id AND p1.idx = x.idx
  LEFT JOIN a1 ON a1.entity_id = x.entity_id AND a1.idx = x.idx AND rn = 1 LEFT JOIN n1 ON n1.entity_id = x.entity_id AND n1.idx = x.idx),
r1 AS (SELECT *, loudness * 0.5::DOUBLE + flux * 0.25::DOUBLE + onset * 0.25::DOUBLE AS energy_score, CASE WHEN lag(chord) OVER (PARTITION BY entity_id ORDER BY idx) <> chord THEN 1 ELSE 0 END AS chord_change,
  sum(CASE WHEN note_count > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY idx) AS island FROM r0),
wide AS (SELECT *, sum(CASE WHEN note_count > 0 THEN 0 ELSE greatest(1, end_t - t) END) OVER (PARTITION BY entity_id, island ORDER BY idx)::BIGINT AS silence_gap FROM r1)"""


@query("beat_feature_row", f"WITH {WIDE} SELECT event_id, section, phrase, chord, chord_confidence, chord_change, {', '.join(f for f in FEATURES if f != 'chord_confidence')}, note_count, accent_id, silence_gap FROM wide")
def beat_feature_row(spark, sf_dir):
    return wide_rows(spark, sf_dir).select("event_id", "section", "phrase", "chord", "chord_change", *FEATURES, "note_count", "accent_id", "silence_gap")


def _stat(f: str) -> str:
    x, by = (f"({f} * 4)::BIGINT", " / 4") if f == "energy_score" else (f, "")
    return f"round(sum({x})::DOUBLE / count(*){by}, 6) AS m_{f}, round(sqrt((count(*)::HUGEINT * sum({x}::HUGEINT * {x}) - sum({x})::HUGEINT * sum({x})::HUGEINT)::DOUBLE) / count(*){by}, 6) AS d_{f}"


def _z(f: str) -> str:
    return f"CASE WHEN d_{f} < 1e-9::DOUBLE THEN 0 ELSE round(({f} - m_{f}) / d_{f} * 1000000)::BIGINT END AS z_{f}"


ORDER = "OVER (PARTITION BY entity_id ORDER BY idx"
DERIVED = f"""{WIDE}, st AS (SELECT entity_id, {', '.join(map(_stat, FEATURES))} FROM wide GROUP BY 1),
z AS (SELECT wide.*, {', '.join(map(_z, FEATURES))} FROM wide JOIN st USING (entity_id)),
d0 AS (SELECT *, z_energy_score - coalesce(lag(z_energy_score) {ORDER}), z_energy_score) AS energy_delta, z_density - coalesce(lag(z_density) {ORDER}), z_density) AS density_delta, z_vocals_stem - coalesce(lag(z_vocals_stem) {ORDER}), z_vocals_stem) AS vocal_stem_delta,
  least(1000000, round((z_vocal_presence * 55 + z_vocals_stem * 45) / 100::DOUBLE)::BIGINT) AS vocal_focus, greatest(0, z_drums_stem - greatest(z_vocals_stem, z_harmonic_stem)) AS percussion_focus,
  greatest(0, round((z_harmonic_stem * 60 + z_bass_stem * 40 - z_vocals_stem * 50) / 100::DOUBLE)::BIGINT) AS instrumental_focus, least(1000000, greatest(0, round((1000000 - z_chord_confidence + chord_change * 1000000) / 2::DOUBLE)::BIGINT)) AS tension FROM z),
d AS (SELECT *, {', '.join(f"round(sum({x}) {ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)::DOUBLE / count(*) {ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))::BIGINT AS {x.removeprefix('z_')}_{name}" for name, n in beat_features.ROLLING.items() for x in beat_features.ROLLED)} FROM d0)"""
DERIVED_COLUMNS = ["energy_delta", "density_delta", "vocal_stem_delta", "vocal_focus", "percussion_focus", "instrumental_focus", "tension", *[f"{x.removeprefix('z_')}_{name}" for name in beat_features.ROLLING for x in beat_features.ROLLED]]


def derived_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature layer, an artifact that later steps and later runs read."""
    code = code_of(beat_features, joins, windows, sys.modules[__name__])

    def make() -> DataFrame:
        return beat_features.derived(beat_features.scored(artifact(wide_rows(spark, sf_dir), "wide-rows")))

    return reusable(spark, "features", make, [f"{sf_dir}/events.parquet"], {"code": code})


@query("derived_features", f"WITH {DERIVED} SELECT event_id, {', '.join([f'z_{f}' for f in FEATURES] + DERIVED_COLUMNS)} FROM d")
def derived_features(spark, sf_dir):
    return derived_rows(spark, sf_dir).select("event_id", *[f"z_{f}" for f in FEATURES], *DERIVED_COLUMNS)


def _threshold(name: str) -> str:
    x, factor, bound, least = rule_events.DYNAMIC[name]
    return f"round({'greatest' if least else 'least'}({bound}::DOUBLE, m_{x} + ({factor})::DOUBLE * d_{x}))::BIGINT AS th_{name}"


_SOURCES = sorted({x for x, *_ in rule_events.DYNAMIC.values()})
THRESHOLDS = f"""{DERIVED}, ts AS (SELECT entity_id, count(*) AS rows_, {', '.join(f"CASE WHEN count(*) > 1 THEN sum({x})::DOUBLE / count(*) ELSE 0 END AS m_{x}, CASE WHEN count(*) > 1 THEN sqrt((count(*)::HUGEINT * sum({x}::HUGEINT * {x}) - sum({x})::HUGEINT * sum({x})::HUGEINT)::DOUBLE / (count(*) * (count(*) - 1))::DOUBLE) ELSE 0 END AS d_{x}" for x in _SOURCES)} FROM d GROUP BY 1),
th AS (SELECT entity_id, rows_, {', '.join(map(_threshold, rule_events.DYNAMIC))} FROM ts),
f AS (SELECT d.*, th.* EXCLUDE (entity_id), CASE WHEN rows_ <= 10 THEN 2 WHEN z_energy_score < -400000 THEN 0 WHEN z_energy_score < 600000 THEN 1 ELSE 2 END AS cluster, z_accent_intensity = max(z_accent_intensity) {ORDER} ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS top FROM d JOIN th USING (entity_id))"""


#: The features that rules, states and refinement look at; the others need not be dealt out again.
RULED = ["z_energy_score", "z_onset", "z_bass_activation", "z_accent_intensity", "z_vocal_presence", "energy_delta", "density_delta", "silence_gap", "tension", "tension_local", "energy_score_local"]


def rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with thresholds, the section at each row's start, and a stand-in for the intensity cluster."""
    rows = rule_events.with_thresholds(derived_rows(spark, sf_dir).select(E, "idx", "t", "end_t", "section", *RULED))
    sections = tracks_of(beats_of(spark, sf_dir)).sections
    placed = joins.containing(rows, sections, fallback_last=True).withColumn("start_section", F.col("inside.section")).drop("inside")
    count, score = F.col("entity_rows"), F.col("z_energy_score")
    return artifact(placed.withColumn("cluster", F.when(count <= 10, 2).when(score < -400_000, 0).when(score < 600_000, 1).otherwise(2)), "rule-rows")


@query("rule_thresholds", f"WITH {THRESHOLDS} SELECT entity_id, {', '.join(f'th_{n}' for n in rule_events.DYNAMIC)} FROM th")
def rule_thresholds(spark, sf_dir):
    return rule_events.entity_thresholds(derived_rows(spark, sf_dir)).drop("entity_rows")


def _islands(kind: str, when: str, a: str, b: str, confidence: str, intensity: str) -> str:
    return f"""SELECT entity_id, '{kind}' AS type, start_t, end_t, first_idx, last_idx, section, round(greatest(0::DOUBLE, least(1::DOUBLE, {confidence})) + 1e-9::DOUBLE, 6) AS confidence, round(greatest(0::DOUBLE, least(1::DOUBLE, {intensity})) + 1e-9::DOUBLE, 6) AS intensity FROM (
SELECT entity_id, min(t) AS start_t, max(end_t) AS end_t, min(idx) AS first_idx, max(idx) AS last_idx, arg_min(start_section, idx) AS section, round(sum({a})::DOUBLE / count(*)) AS a, round(sum({b})::DOUBLE / count(*)) AS b
FROM (SELECT * EXCLUDE (section), section AS own, idx - row_number() OVER (PARTITION BY entity_id, section ORDER BY idx) AS g FROM f WHERE {when}) GROUP BY entity_id, own, g)"""


def _rows(kind: str, when: str, confidence: str, intensity: str) -> str:
    return f"SELECT entity_id, '{kind}' AS type, t AS start_t, end_t, idx AS first_idx, idx AS last_idx, start_section AS section, round(greatest(0::DOUBLE, least(1::DOUBLE, {confidence})) + 1e-9::DOUBLE, 6) AS confidence, round(greatest(0::DOUBLE, least(1::DOUBLE, {intensity})) + 1e-9::DOUBLE, 6) AS intensity FROM f WHERE {when}"


_U = "/ 1000000::DOUBLE"
_PAUSE = f"silence_gap >= {rule_events.PAUSE_GAP} AND z_energy_score <= 400000 AND cluster = 0"
CANDIDATES = f"""{THRESHOLDS}, rc AS ({_islands('build', 'energy_delta >= th_build_energy_delta AND tension_local >= th_build_tension AND energy_score_local >= th_build_energy AND cluster >= 1', 'energy_score_local', 'tension_local', f'a {_U} * 0.25::DOUBLE + b {_U} * 0.3::DOUBLE + 0.45::DOUBLE', f'a {_U}')}
UNION ALL {_islands('breakdown', 'energy_delta <= th_breakdown_energy_delta AND density_delta <= -150000 AND cluster <= 1', 'energy_delta', 'density_delta', f'abs(a) {_U} * 0.3::DOUBLE + abs(b) {_U} * 0.2::DOUBLE + 0.45::DOUBLE', f'abs(a) {_U}')}
UNION ALL {_rows('drop', 'cluster = 2 AND energy_delta >= th_drop_energy_delta AND z_onset >= 450000 AND z_bass_activation >= 250000 AND z_accent_intensity >= 250000', f'energy_delta {_U} * 0.2::DOUBLE + z_onset {_U} * 0.15::DOUBLE + z_bass_activation {_U} * 0.2::DOUBLE + 0.45::DOUBLE', f'greatest(z_energy_score, z_accent_intensity) {_U}')}
UNION ALL {_rows('impact_hit', 'z_accent_intensity >= 650000 AND top', f'z_accent_intensity {_U} * 0.5::DOUBLE + 0.4::DOUBLE', f'z_accent_intensity {_U}')}
UNION ALL {_rows('pause_break', _PAUSE, f'silence_gap {_U} * 0.2::DOUBLE + 0.45::DOUBLE', f'1 - z_energy_score {_U}')}
UNION ALL {_rows('_fake', _PAUSE + ' AND tension_local >= th_fake_drop_tension', f'tension_local {_U} * 0.4::DOUBLE + 0.35::DOUBLE', f'tension_local {_U}')}),
events_ AS (SELECT * FROM rc WHERE type <> '_fake' UNION ALL SELECT p.* REPLACE ('fake_drop' AS type) FROM rc p WHERE type = '_fake'
  AND NOT EXISTS (SELECT 1 FROM rc x WHERE x.type = 'drop' AND x.entity_id = p.entity_id AND x.start_t > p.end_t AND x.start_t <= p.end_t + {2 * DAY}))"""


@query("rule_candidates", f"WITH {CANDIDATES} SELECT * FROM events_")
def rule_candidates(spark, sf_dir):
    return rule_events.rule_candidates(rule_rows(spark, sf_dir), release_within=2 * DAY).select(rule_events.EVENT)


_STATES = [
    ("groove_loop", "energy >= th_groove_energy AND bass >= 300000 AND volatility <= 300000", f"energy {_U} * 0.2::DOUBLE + bass {_U} * 0.2::DOUBLE + 0.45::DOUBLE", f"energy {_U}"),
    ("atmospheric_plateau", "energy <= th_atmo_energy AND onset <= 300000 AND volatility <= 200000", f"(1 - energy {_U}) * 0.2::DOUBLE + (1 - onset {_U}) * 0.2::DOUBLE + 0.45::DOUBLE", f"1 - energy {_U}"),
    ("tension_hold", "tension >= th_hold_tension AND NOT has_drop", f"tension {_U} * 0.35::DOUBLE + 0.4::DOUBLE", f"tension {_U}"),
    ("no_drop_plateau", "has_build AND NOT has_drop AND energy BETWEEN 350000 AND 600000", f"tension {_U} * 0.25::DOUBLE + energy {_U} * 0.15::DOUBLE + 0.4::DOUBLE", f"energy {_U}"),
]


STATES = f"""cards AS (SELECT entity_id, section, {', '.join(f'round(sum({x})::DOUBLE / count(*))::BIGINT AS {n}' for x, n in (('z_energy_score', 'energy'), ('z_onset', 'onset'), ('z_bass_activation', 'bass'), ('tension', 'tension')))}, max(z_energy_score) - min(z_energy_score) AS volatility,
  min(t) AS start_t, max(end_t) AS end_t, min(idx) AS first_idx, max(idx) AS last_idx, max(th_groove_energy) AS th_groove_energy, max(th_atmo_energy) AS th_atmo_energy, max(th_hold_tension) AS th_hold_tension FROM f WHERE section IS NOT NULL GROUP BY 1, 2),
flags AS (SELECT entity_id, section, max(type = 'build') AS has_build, max(type = 'drop') AS has_drop FROM events_ WHERE section IS NOT NULL GROUP BY 1, 2),
both_ AS (SELECT cards.*, coalesce(has_build, false) AS has_build, coalesce(has_drop, false) AS has_drop FROM cards LEFT JOIN flags USING (entity_id, section)),
states AS ({' UNION ALL '.join(f"SELECT entity_id, '{kind}' AS type, start_t, end_t, first_idx, last_idx, section, round(greatest(0::DOUBLE, least(1::DOUBLE, {c})) + 1e-9::DOUBLE, 6) AS confidence, round(greatest(0::DOUBLE, least(1::DOUBLE, {i})) + 1e-9::DOUBLE, 6) AS intensity FROM both_ WHERE {when}" for kind, when, c, i in _STATES)})"""


@query("section_candidates", f"WITH {CANDIDATES}, {STATES} SELECT * FROM states")
def section_candidates(spark, sf_dir):
    rows = rule_rows(spark, sf_dir)
    return rule_events.section_candidates(rows, artifact(rule_events.rule_candidates(rows, release_within=2 * DAY), "rule-candidates")).select(rule_events.EVENT)
