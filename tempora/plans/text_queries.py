"""Queries of descriptions and compact rows, over cards and beats made from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import PITCH_CLASSES
from ..operators import texts
from ..operators.section_hints import REPETITION, SUSTAIN
from .feature_queries import beats_of
from .hint_queries import CONTOURS, LABELS, TEXTURES, _ladder, _pick, _picked
from .registry import HOUR, TL, query
from .timeline_queries import E

EN = f"{TL}, en AS (SELECT * REPLACE (coalesce(k, 0) AS k), (idx - 1) // 8 AS section FROM tl)"
CARDS = f"""{EN}, s AS (SELECT entity_id, section, min(bar) AS bar_start, max(bar) AS bar_end, sum(k)::BIGINT AS sk, sum(energy)::BIGINT AS se FROM en GROUP BY 1, 2),
c AS (SELECT entity_id, section, 'section-' || (section + 1)::VARCHAR AS section_id, CASE WHEN sk % 4 <> 0 THEN {_picked(LABELS, 'sk')} END AS name, bar_start, bar_end, {_picked(TEXTURES, 'se')} AS texture, {_picked(CONTOURS, 'sk')} AS contour, CASE WHEN se % 6 <> 0 THEN se % 2500 / 100::DOUBLE END AS density, CASE WHEN sk % 5 <> 0 THEN se % 100 / 100::DOUBLE END AS repetition, sk % 25 / 100::DOUBLE AS sustain FROM s)"""
_DENSE = f"CASE WHEN density IS NULL THEN 'unknown density' ELSE {_ladder('density', texts.DENSITY, 'sparse')} END"
_REP = f"CASE WHEN repetition IS NULL THEN 'unknown repetition' ELSE {_ladder('repetition', REPETITION, 'limited repetition')} END"
_SUS = _ladder("sustain", SUSTAIN, "clipped note lengths")


@query("section_descriptions", f"""WITH {CARDS}, n AS (SELECT *, coalesce(name, section_id) AS x FROM c)
SELECT entity_id, section_id, upper(x[1]) || lower(x[2:]) || ' spans bars ' || bar_start || '-' || bar_end || ' with a ' || texture || ' texture, ' || contour || ' contour, ' || {_DENSE} || ' activity (' || CASE WHEN density IS NULL THEN 'n/a' ELSE printf('%.1f', density) END || ' notes per bar), ' || {_REP} || ', and ' || {_SUS} || '.' AS description FROM n""")
def section_descriptions(spark, sf_dir):
    rows = beats_of(spark, sf_dir).withColumn("section", F.floor((F.col("idx") - 1) / 8).cast("long"))
    s = rows.groupBy(E, "section").agg(F.min("bar").alias("bar_start"), F.max("bar").alias("bar_end"), F.sum("k").alias("sk"), F.sum("energy").alias("se"))
    sk, se = F.col("sk"), F.col("se")
    made = s.select(E, F.format_string("section-%d", F.col("section") + 1).alias("section_id"), F.when(sk % 4 != 0, _pick(LABELS, sk)).alias("section_name"), "bar_start", "bar_end", _pick(TEXTURES, se).alias("texture"), _pick(CONTOURS, sk).alias("melodic_contour"), F.when(se % 6 != 0, se % 2500 / F.lit(100.0)).alias("density_mean"), F.when(sk % 5 != 0, se % 100 / F.lit(100.0)).alias("repetition_score"), (sk % 25 / F.lit(100.0)).alias("sustain_ratio"))
    return texts.section_descriptions(made).select(E, "section_id", "description")


@query("phrase_group_descriptions", f"""WITH {EN}, p AS (SELECT entity_id, idx AS place, 'g' || (energy % 7)::VARCHAR AS g, {_picked(LABELS, 'k')} AS sec, {_picked(CONTOURS, '(k + energy)')} AS con, energy % 900 / 10::DOUBLE AS density FROM en WHERE idx % 2 = 1),
w AS (SELECT entity_id, g, count(*) AS n, sum(density) / count(*) AS density FROM p GROUP BY 1, 2 HAVING count(*) >= 2), a AS (SELECT entity_id, g, arg_max(sec, row(n, -f)) AS sec FROM (SELECT entity_id, g, sec, count(*) AS n, min(place) AS f FROM p GROUP BY 1, 2, 3) GROUP BY 1, 2), b AS (SELECT entity_id, g, arg_max(con, row(n, -f)) AS con FROM (SELECT entity_id, g, con, count(*) AS n, min(place) AS f FROM p GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT entity_id, g AS phrase_group, 'Group ' || g || ' recurs ' || n || ' times, usually in ' || sec || ', with ' || con || ' contour and ' || {_ladder('density', texts.PHRASE_DENSITY, 'restrained activity')} || ' (' || printf('%.1f', density) || ' notes per bar).' AS description FROM w JOIN a USING (entity_id, g) JOIN b USING (entity_id, g)""")
def phrase_group_descriptions(spark, sf_dir):
    rows, k, e = beats_of(spark, sf_dir), F.col("k"), F.col("energy")
    group = F.format_string("g%d", e % 7)
    made = rows.where("idx % 2 = 1").select(E, F.col("idx").alias("place"), group.alias("phrase_group"), F.concat(F.lit("Group "), group).alias("label"), _pick(LABELS, k).alias("section_name"), _pick(CONTOURS, k + e).alias("melodic_contour"), (e % 900 / F.lit(10.0)).alias("density"))
    return texts.phrase_group_descriptions(made)


@query("compact_beats", f"""WITH {EN}, ba AS (SELECT entity_id, t + k % 9 * {2 * HOUR} AS t, 30 + k % 30 AS pitch FROM en WHERE label = 'purchase'), ch AS (SELECT entity_id, t AS start_t, label || (bar % 3)::VARCHAR AS chord FROM en WHERE idx % 4 = 2),
n AS (SELECT x.entity_id, x.pitch, arg_min(y.idx, row(abs(x.t - y.t), y.t)) AS idx FROM (SELECT *, row_number() OVER () AS r FROM ba) x JOIN en y USING (entity_id) GROUP BY x.r, x.entity_id, x.pitch), l AS (SELECT entity_id, idx, min(pitch) AS pitch FROM n GROUP BY 1, 2), f AS (SELECT entity_id, arg_min(chord, start_t) AS chord FROM ch GROUP BY 1)
SELECT en.entity_id, en.idx, round(en.t / 1000000::DOUBLE, 6) AS time, beat_in_bar AS beat, bar, [{', '.join(f"'{p}'" for p in PITCH_CLASSES)}][pitch % 12 + 1] AS bass, coalesce((SELECT arg_max(chord, start_t) FROM ch WHERE ch.entity_id = en.entity_id AND start_t <= en.t), f.chord) AS chord, CASE WHEN beat_in_bar = 1 THEN 'downbeat' ELSE 'beat' END AS type FROM en LEFT JOIN l ON l.entity_id = en.entity_id AND l.idx = en.idx LEFT JOIN f ON f.entity_id = en.entity_id""")
def compact_beats(spark, sf_dir):
    rows, k = beats_of(spark, sf_dir), F.col("k")
    bass = rows.where("label = 'purchase'").select(E, (F.col("t") + k % 9 * (2 * HOUR)).alias("t"), (k % 30 + 30).alias("pitch"))
    chords = rows.where("idx % 4 = 2").select(E, F.col("t").alias("start_t"), F.concat("label", (F.col("bar") % 3).cast("string")).alias("chord"))
    return texts.beat_rows(rows, bass, chords)


@query("report_states", f"WITH {EN} SELECT event_id, CASE WHEN k % 4 = 0 THEN 'missing' WHEN k % 4 = 1 THEN 'present' WHEN k % 4 = 2 THEN 'present' ELSE label END AS state FROM en")
def report_states(spark, sf_dir):
    k = F.col("k")
    made = beats_of(spark, sf_dir).select("event_id", F.when(k % 4 != 0, "{}").alias("report"), F.when(k % 4 == 2, "").when(k % 4 == 3, F.col("label")).alias("status"))
    return made.select("event_id", texts.report_state(F.col("report"), F.col("status")).alias("state"))
