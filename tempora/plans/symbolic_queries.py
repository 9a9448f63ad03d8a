"""Queries of the symbolic layer, over notes of five sources made from the events."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import sequences, symbolic
from ..sources.tables import artifact
from .feature_queries import beats_of, tracks_of
from .registry import HOUR, TL, query
from .section_queries import bars_of
from .timeline_queries import E

DAY = 24 * HOUR
SOURCES = {"click": "harmonic", "view": "vocals", "purchase": "bass", "signup": "drums", "error": "full_mix"}
TOLERANCE = {"harmonic": 8 * HOUR, "vocals": 10 * HOUR, "bass": 3 * HOUR, "drums": 3 * HOUR, "full_mix": 2 * HOUR}


def layer_of(spark, sf_dir) -> symbolic.SymbolicLayer:
    rows, k, e = beats_of(spark, sf_dir), F.col("k"), F.col("energy")
    source = F.element_at(F.create_map(*[F.lit(x) for pair in SOURCES.items() for x in pair]), F.col("label"))
    notes = rows.where(F.col("label").isin(list(SOURCES))).select(E, "event_id", source.alias("source"), (F.col("t") + k % 13 * HOUR).alias("t"), ((k % 9 + 1) * (3 * HOUR)).alias("length"), (k % 50 + e % 11 + 28).cast("int").alias("pitch"), (e % 1000 * 1000).alias("confidence"))
    bars = bars_of(spark, sf_dir).select(E, "bar", "start_t", "end_t")
    return symbolic.symbolic_layer(notes, rows.select(E, "idx", F.col("bar").cast("long").alias("bar"), "t", "end_t"), bars, tracks_of(rows).sections, 2 * DAY, TOLERANCE, None, artifact)


_SOURCE = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCES.items()) + " END"
_TOL = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TOLERANCE.items()) + " END"
_MOST = max(TOLERANCE.values())
NOTES = f"""{TL}, en AS (SELECT * REPLACE (coalesce(k, 0) AS k), coalesce(next_t, t) AS end_t FROM tl),
bars AS (SELECT entity_id, bar, start_t, coalesce(lead(start_t) OVER (PARTITION BY entity_id ORDER BY bar), last_t) AS end_t FROM (SELECT entity_id, bar, min(t) AS start_t, max(t) AS last_t FROM en GROUP BY 1, 2)),
sec AS (SELECT entity_id, (idx - 1) // 8 AS section, min(t) AS start_t, max(t) AS end_t FROM en GROUP BY 1, 2),
n0 AS (SELECT entity_id, event_id, {_SOURCE} AS source, t + k % 13 * {HOUR} AS t, (k % 9 + 1) * {3 * HOUR} AS length, k % 50 + energy % 11 + 28 AS pitch, energy % 1000 * 1000 AS confidence FROM en WHERE label IN ({', '.join(f"'{k}'" for k in SOURCES)})),
nb AS (SELECT n0.entity_id, n0.event_id, arg_min(struct_pack(bar := en.bar, delta := abs(n0.t - en.t)), row(abs(n0.t - en.t), en.t)) AS near FROM n0 JOIN en USING (entity_id) GROUP BY 1, 2),
n1 AS (SELECT n0.*, near.delta <= {_TOL} AS resolved, CASE WHEN near.delta <= {_TOL} THEN near.bar ELSE bars.bar END AS aligned_bar FROM n0 JOIN nb USING (entity_id, event_id) LEFT JOIN bars ON bars.entity_id = n0.entity_id AND n0.t >= start_t AND n0.t < end_t),
q0 AS (SELECT entity_id, source, count(*) AS note_count, count_if(resolved) / count(*) AS resolved, sum(confidence) / count(*) / 1000000 AS confidence, median(confidence) / 1000000 AS middle, min(pitch) AS pitch_min, max(pitch) AS pitch_max, median(length) / 1000000 AS length, count_if(pitch <= 55) / count(*) AS low, count_if(pitch >= 60) / count(*) AS high FROM n1 GROUP BY 1, 2),
q AS (SELECT *, CASE source WHEN 'bass' THEN low >= 0.45::DOUBLE WHEN 'harmonic' THEN resolved >= 0.2::DOUBLE WHEN 'vocals' THEN confidence >= 0.35::DOUBLE AND high >= 0.5::DOUBLE WHEN 'full_mix' THEN confidence >= 0.3::DOUBLE ELSE false END AS promoted FROM q0),
nf AS (SELECT n1.* FROM n1 JOIN q USING (entity_id, source) WHERE promoted),
bw AS (SELECT b.entity_id, b.bar, b.start_t, b.end_t, pitch, n.t, n.t + length AS until FROM bars b JOIN nf n ON n.entity_id = b.entity_id AND n.t < b.end_t AND n.t + length > b.start_t AND b.end_t > b.start_t),
bc0 AS (SELECT entity_id, bar, count(*) AS n, greatest(count_if(t <= start_t AND until > start_t), count_if(t <= (start_t + end_t) // 2 AND until > (start_t + end_t) // 2), count_if(t <= end_t - 1 AND until > end_t - 1)) AS peak, min(pitch) AS pitch_min, max(pitch) AS pitch_max, round(sum(CASE WHEN pitch >= 48 THEN pitch END) * 1000000 / count(CASE WHEN pitch >= 48 THEN 1 END))::BIGINT AS centroid FROM bw GROUP BY 1, 2),
bc AS (SELECT bars.*, coalesce(n, 0) AS note_count, coalesce(peak, 0) AS active_note_peak, pitch_min, pitch_max, centroid FROM bars LEFT JOIN bc0 USING (entity_id, bar)),
si AS (SELECT s.entity_id, section, bc.* EXCLUDE (entity_id) FROM sec s JOIN bc ON bc.entity_id = s.entity_id AND bc.start_t < s.end_t AND bc.end_t > s.start_t AND bc.end_t > bc.start_t AND s.end_t > s.start_t),
sl AS (SELECT entity_id, section, list(centroid ORDER BY bar) AS v FROM si WHERE centroid IS NOT NULL GROUP BY 1, 2),
sd AS (SELECT entity_id, section, len(v) AS m, (list_sum(v[-greatest(len(v) // 3, 1):]) - list_sum(v[:greatest(len(v) // 3, 1)])) / greatest(len(v) // 3, 1) / 1000000 AS drift, list_max(v) - list_min(v) AS spread FROM sl),
sw AS (SELECT entity_id, section, min(bar) AS bar_start, max(bar) AS bar_end, sum(active_note_peak) / count(*) AS peak, sum(note_count) / count(*) / 4 AS density FROM si GROUP BY 1, 2),
so AS (SELECT n.entity_id, section, count(*) AS note_count, min(pitch) AS pitch_min, max(pitch) AS pitch_max, round(coalesce(avg(CASE WHEN source <> 'bass' THEN pitch END), avg(pitch)), 6) AS centroid, round(count_if(length >= 500000) / count(*), 6) AS sustain FROM nf n JOIN si ON si.entity_id = n.entity_id AND si.bar = n.aligned_bar GROUP BY 1, 2),
sc AS (SELECT sec.entity_id, sec.section, bar_start, bar_end, coalesce(note_count, 0) AS note_count, pitch_min, pitch_max, centroid AS register_centroid, coalesce(peak, 0) AS peak, density, m, drift, spread, coalesce(sustain, 0) AS sustain_ratio FROM sec LEFT JOIN sw USING (entity_id, section) LEFT JOIN sd USING (entity_id, section) LEFT JOIN so USING (entity_id, section))"""
_REGISTER = lambda x: f"CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} >= 84 THEN 'very-high' WHEN {x} >= 72 THEN 'high' WHEN {x} >= 60 THEN 'mid' WHEN {x} >= 48 THEN 'low-mid' ELSE 'low' END"
_TEXTURE = "CASE WHEN peak >= 4 OR coalesce(density, 0) >= 3 THEN 'layered' WHEN peak >= 2 OR coalesce(density, 0) >= 1.5::DOUBLE THEN 'polyphonic' WHEN coalesce(density, 0) >= 0.7::DOUBLE THEN 'melodic' ELSE 'sparse' END"


@query(
    "source_quality",
    f"""WITH {NOTES} SELECT entity_id, source, note_count, round(resolved, 6) AS alignment_resolved_ratio, round(confidence, 6) AS confidence_mean, round(middle, 6) AS confidence_median, round(length, 6) AS median_duration, round(low, 6) AS low_register_ratio, round(high, 6) AS mid_high_ratio, pitch_min, pitch_max, promoted,
  CASE WHEN promoted THEN 'promoted' WHEN source IN ('bass', 'harmonic') THEN 'rejected' ELSE 'auxiliary_only' END AS decision, CASE source {' '.join(f"WHEN '{s}' THEN CASE WHEN promoted THEN '{a}' ELSE '{b}' END" for s, (a, b) in symbolic.REASONS.items())} ELSE '{symbolic.PERCUSSIVE}' END AS reason FROM q""",
)
def source_quality(spark, sf_dir):
    return layer_of(spark, sf_dir).quality


@query("symbolic_bars", f"WITH {NOTES} SELECT entity_id, bar, start_t, end_t, note_count, note_count / 4 AS density, active_note_peak, pitch_min, pitch_max, centroid, {_REGISTER('centroid / 1000000')} AS register_label FROM bc")
def symbolic_bars(spark, sf_dir):
    return layer_of(spark, sf_dir).bars


@query(
    "symbolic_sections",
    f"""WITH {NOTES} SELECT entity_id, section, bar_start, bar_end, note_count, pitch_min, pitch_max, register_centroid, {_REGISTER('register_centroid')} AS register_label, {_TEXTURE} AS texture,
  CASE WHEN coalesce(m, 0) < 2 THEN 'static' WHEN abs(drift) <= 1.5::DOUBLE AND spread <= 3000000 THEN 'static' WHEN drift >= 3 THEN 'rising' WHEN drift <= -3 THEN 'falling' ELSE 'undulating' END AS melodic_contour, round(density, 6) AS density_mean, sustain_ratio FROM sc""",
)
def symbolic_sections(spark, sf_dir):
    return layer_of(spark, sf_dir).sections


@query(
    "symbolic_songs",
    f"""WITH {NOTES}, tx AS (SELECT entity_id, {_TEXTURE} AS texture, density FROM sc), ty AS (SELECT entity_id, texture, count(*) AS n FROM tx GROUP BY 1, 2), tz AS (SELECT entity_id, arg_min(texture, row(-n, texture)) AS texture FROM ty GROUP BY 1), td AS (SELECT entity_id, round(sum(round(round(density, 6) * 1000000)::BIGINT) / count(density) / 1000000, 6) AS density_mean FROM tx GROUP BY 1),
ns AS (SELECT entity_id, count(*) AS note_count, min(pitch) AS pitch_min, max(pitch) AS pitch_max FROM nf GROUP BY 1), st AS (SELECT entity_id, abs(pitch - lag(pitch) OVER (PARTITION BY entity_id ORDER BY t, event_id)) AS s FROM nf WHERE source = 'bass'),
bm AS (SELECT entity_id, count(s) AS n, count_if(s = 0) AS z, median(s) AS m FROM st GROUP BY 1)
SELECT entity_id, coalesce(note_count, 0) AS note_count, pitch_min, pitch_max, texture, density_mean, CASE WHEN coalesce(n, 0) < 1 THEN 'minimal' WHEN z >= 0.45::DOUBLE * n THEN 'pedal' WHEN m <= 2 THEN 'stepwise' WHEN m >= 5 THEN 'leaping' ELSE 'mixed' END AS bass_motion FROM tz JOIN td USING (entity_id) LEFT JOIN ns USING (entity_id) LEFT JOIN bm USING (entity_id)""",
)
def symbolic_songs(spark, sf_dir):
    return layer_of(spark, sf_dir).songs


_MOVES = {(tonic, major): sequences.chord_moves(tonic, major) for tonic in range(12) for major in (False, True)}
_TO = ", ".join(f"({t}, {str(m).lower()}, [{', '.join(repr(float(moves[(s + 1) % 24][s])) for s in range(24))}])" for (t, m), moves in _MOVES.items())
_STAY, _HEARD, _UNHEARD = (repr(float(np.log(x))) for x in (sequences.STAY, sequences.HEARD, sequences.MISHEARD / 23))
_HEAR = f"CASE WHEN n.place = s THEN {_HEARD}::DOUBLE ELSE {_UNHEARD}::DOUBLE END"
#: Chords as the smoothing hears them, made of the rows: most bars hold one, some rows are off, some no chord at all.
_CHORD = "CASE WHEN k % 13 = 0 THEN 'N' WHEN k % 5 = 0 THEN ['C', 'D#', 'F#m', 'A'][energy % 4 + 1] ELSE ['C', 'Am', 'F', 'G', 'Dm'][(bar // 2 + entity_id) % 5 + 1] END"


@query(
    "chord_smoothing",
    f"""WITH RECURSIVE {TL}, en AS (SELECT * REPLACE (coalesce(k, 0) AS k) FROM tl), lb AS (SELECT entity_id, idx, {_CHORD} AS label FROM en),
mv AS (SELECT * FROM (VALUES {_TO}) AS v(tonic, major, away)), ks AS (SELECT entity_id, entity_id % 12 AS tonic, entity_id % 2 = 0 AS major, count(*) AS n FROM en WHERE entity_id % 4 <> 3 GROUP BY 1 HAVING count(*) > 1),
pl AS (SELECT lb.entity_id, idx, coalesce(list_position([{', '.join(f"'{c}'" for c in sequences.CHORDS)}], label), 0) AS place, away, n FROM lb JOIN ks USING (entity_id) JOIN mv ON mv.tonic = ks.tonic AND mv.major = ks.major),
w AS (SELECT entity_id, idx, n, [{_HEAR} for s in range(1, 25)] AS v, NULL::BIGINT[] AS back FROM (SELECT * FROM pl WHERE idx = 1) n UNION ALL
  SELECT x.entity_id, x.idx, x.n, [x.c[s].v + CASE WHEN x.place = s THEN {_HEARD}::DOUBLE ELSE {_UNHEARD}::DOUBLE END for s in range(1, 25)], [x.c[s].b for s in range(1, 25)] FROM (
    SELECT n.entity_id, n.idx, n.n, n.place, [list_transform([[w.v[p] + CASE WHEN p = s THEN {_STAY}::DOUBLE ELSE n.away[s] END for p in range(1, 25)]], lambda l: {{'v': list_max(l), 'b': list_position(l, list_max(l))}})[1] for s in range(1, 25)] AS c FROM w JOIN pl n ON n.entity_id = w.entity_id AND n.idx = w.idx + 1) x),
b AS (SELECT entity_id, idx, list_position(v, list_max(v)) AS s, back FROM w WHERE idx = n UNION ALL SELECT w.entity_id, w.idx, b.back[b.s], w.back FROM b JOIN w ON w.entity_id = b.entity_id AND w.idx = b.idx - 1)
SELECT entity_id, idx, [{', '.join(f"'{c}'" for c in sequences.CHORDS)}][s] AS label FROM b UNION ALL SELECT entity_id, idx, label FROM lb WHERE entity_id NOT IN (SELECT entity_id FROM ks)""",
)
def chord_smoothing(spark, sf_dir):
    rows, k = beats_of(spark, sf_dir), F.col("k")
    pick = lambda names, x: F.element_at(F.array(*[F.lit(n) for n in names]), (x % len(names) + 1).cast("int"))
    label = F.when(k % 13 == 0, "N").when(k % 5 == 0, pick(["C", "D#", "F#m", "A"], F.col("energy"))).otherwise(pick(["C", "Am", "F", "G", "Dm"], F.floor(F.col("bar") / 2) + F.col(E)))
    keys = rows.select(E).distinct().select(E, (F.col(E) % 12).alias("tonic"), (F.col(E) % 2 == 0).alias("major"), F.when(F.col(E) % 4 == 3, 0.4).otherwise(0.8).alias("confidence"))
    return sequences.smooth_chords(rows.select(E, "idx", label.alias("label")), keys)


@query("phrase_grouping")
def phrase_grouping(spark, sf_dir):
    """Windows of eight rows as phrases; no SQL, tested by a plain walk."""
    rows, pitch = beats_of(spark, sf_dir), F.col("k") % 24 + 48
    by = F.floor((F.col("idx") - 1) / 8).cast("long")
    classes = F.slice(F.transform(F.array_sort(F.collect_list(F.struct(pitch.alias("p")))), lambda x: (x["p"] % 12).cast("int")), 1, 5)
    counts = F.array(*[F.count_if(pitch % 12 == i).cast("double") for i in range(12)])
    made = rows.groupBy(E, by.alias("idx")).agg((F.sum(pitch) / F.count("*")).alias("centroid"), (F.count("*") / 2.0).alias("density"), classes.alias("classes"), counts.alias("vector"), F.sum("energy").alias("e"))
    return sequences.phrase_groups(made.select(E, "idx", (F.col("e") % 2 + 2).alias("bar_count"), F.when(F.col("e") % 3 == 0, "rising").otherwise("static").alias("contour"), F.when(F.col("e") % 7 != 0, F.col("centroid")).alias("centroid"), "density", "classes", "vector"))
