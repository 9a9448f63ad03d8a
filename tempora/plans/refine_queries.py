"""Queries of refined and guided events, over the rule candidates and made-up phrases, lines and hints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import refine, rule_events
from ..sources.tables import artifact
from .feature_queries import CANDIDATES, DAY, DERIVED, MINUTE, _U, beats_of, derived_rows, rule_rows, tracks_of
from .registry import HOUR, query
from .timeline_queries import E

CHARACTERS = ["groove_plateau", "ambient_opening", "breath_space", "focal_lift"]
HINTS = ["Snare roll", "it FADES out", "the drums, then it ends", "nothing", "ride cymbal", "long tail"]


def _means(spans: str, name: str, key: str, start: str, end: str, means: dict[str, str], prefix: str = "", source: str = "d") -> str:
    """A CTE of the means over rows that share time with each span."""
    cols = ", ".join(f"round(sum({x})::DOUBLE / count(*)) {_U} AS {prefix}{n}" for n, x in means.items())
    return f"{name} AS (SELECT w.entity_id, w.{key}, count(*) AS {prefix}n, max(r.end_t) AS {prefix}last_t, {cols} FROM {spans} w JOIN {source} r ON r.entity_id = w.entity_id AND r.t < {end} AND r.end_t > {start} AND r.end_t > r.t AND {end} > {start} GROUP BY 1, 2)"


def _one(x: str) -> str:
    return f"greatest(0::DOUBLE, least(1::DOUBLE, {x}))"


def _up(x: str) -> str:
    return f"greatest(0::DOUBLE, {x})"


_DROP = {
    "drop_explode": f"accent * 0.4::DOUBLE + {_one('delta * 2::DOUBLE')} * 0.25::DOUBLE + spectral_rise * 0.2::DOUBLE + onset * 0.15::DOUBLE",
    "drop_groove": f"bass * 0.4::DOUBLE + energy * 0.3::DOUBLE + onset * 0.2::DOUBLE + {_up('1 - accent')} * 0.1::DOUBLE",
    "drop_punch": f"accent * 0.5::DOUBLE + {_one('delta * 2::DOUBLE')} * 0.3::DOUBLE + {_up('1 - energy')} * 0.2::DOUBLE",
    "soft_release": f"{_up('0.75::DOUBLE - accent')} * 0.4::DOUBLE + energy * 0.35::DOUBLE + {_up('0.55::DOUBLE - onset')} * 0.25::DOUBLE",
}
_LENGTH = f"((end_t - start_t) / {float(HOUR)}::DOUBLE)"
_PLATEAU = {
    "groove_loop": f"bass * 0.3::DOUBLE + score * 0.25::DOUBLE + onset * 0.2::DOUBLE + least(1::DOUBLE, {_LENGTH} / 16::DOUBLE) * 0.15::DOUBLE + CASE WHEN contains(section_character, 'groove') THEN 1 ELSE 0 END * 0.1::DOUBLE",
    "atmospheric_plateau": f"{_up('0.6::DOUBLE - onset')} * 0.32::DOUBLE + {_up('0.55::DOUBLE - bass')} * 0.22::DOUBLE + {_up('0.5::DOUBLE - score')} * 0.18::DOUBLE + least(1::DOUBLE, {_LENGTH} / 16::DOUBLE) * 0.18::DOUBLE + CASE WHEN contains(section_character, 'ambient') OR contains(section_character, 'breath') THEN 1 ELSE 0 END * 0.1::DOUBLE",
    "no_drop_plateau": f"least(1::DOUBLE, {_LENGTH} / 12::DOUBLE) * 0.2::DOUBLE + score * 0.15::DOUBLE + 0.3::DOUBLE",
}


def _top(scores: dict[str, str], p: str) -> str:
    return ", ".join(f"round({_one(s)} + 1e-9::DOUBLE, 6) AS {p}{i}" for i, s in enumerate(scores.values()))


def _variant(scores: dict[str, str], p: str, least: float, lead: float) -> str:
    all_ = ", ".join(f"{p}{i}" for i in range(len(scores)))
    name = "CASE " + " ".join(f"WHEN {p}{i} = list_max([{all_}]) THEN '{n}'" for i, n in enumerate(scores)) + " END"
    return f"CASE WHEN list_max([{all_}]) >= {least}::DOUBLE AND list_max([{all_}]) - list_reverse_sort([{all_}])[2] >= {lead}::DOUBLE THEN {name} END AS {p}v, list_max([{all_}]) AS {p}t"


_SPANS = "ev AS (SELECT *, type || ':' || first_idx AS event_key, [" + ", ".join(f"'{c}'" for c in CHARACTERS) + "][coalesce(section, 0) % 4 + 1] AS section_character FROM (SELECT * FROM events_ UNION ALL SELECT * REPLACE ('no_drop_plateau' AS type) FROM events_ WHERE type = 'impact_hit'))"
_HELD = {"delta": "energy_delta", "accent": "z_accent_intensity", "bass": "z_bass_activation", "energy": "energy_score_local", "onset": "z_onset", "vocal": "z_vocal_presence", "score": "z_energy_score"}


@query(
    "refined_events",
    f"""WITH {CANDIDATES}, {_SPANS}, {_means('ev', 'h', 'event_key', 'w.start_t', 'w.end_t', _HELD)}, {_means('ev', 'x', 'event_key', 'w.end_t', f'w.end_t + {DAY}', {'rise': 'greatest(0, energy_delta)'}, 'next_')},
j AS (SELECT ev.*, 0::DOUBLE AS spectral_rise, coalesce(n, 0) AS n, {', '.join(f'coalesce({m}, 0) AS {m}' for m in _HELD)}, coalesce(next_rise, 0) AS rise FROM ev LEFT JOIN h USING (entity_id, event_key) LEFT JOIN x USING (entity_id, event_key)),
s AS (SELECT *, {_top(_DROP, 'd')}, {_top(_PLATEAU, 'p')} FROM j), v AS (SELECT *, {_variant(_DROP, 'd', 0.62, 0.05)}, {_variant(_PLATEAU, 'p', 0.55, 0.04)}, type IN ('breakdown', 'pause_break') AND rise >= 0.18::DOUBLE AS reset FROM s)
SELECT entity_id, event_key, CASE WHEN n > 0 AND type = 'drop' THEN coalesce(dv, type) WHEN n > 0 AND type = 'no_drop_plateau' THEN coalesce(pv, type) WHEN reset THEN 'energy_reset' ELSE type END AS refined,
  round(CASE WHEN type = 'drop' AND n > 0 THEN least(1::DOUBLE, confidence + (dt - 0.5::DOUBLE) * 0.15::DOUBLE) WHEN type = 'no_drop_plateau' AND n > 0 THEN least(1::DOUBLE, greatest(confidence, pt * 0.9::DOUBLE)) WHEN reset THEN least(1::DOUBLE, greatest(confidence, rise * 0.5::DOUBLE + 0.55::DOUBLE)) ELSE confidence END + 1e-9::DOUBLE, 6) AS refined_confidence FROM v""",
)
def refined_events(spark, sf_dir):
    rows = rule_rows(spark, sf_dir)
    found = artifact(rule_events.rule_candidates(rows, release_within=2 * DAY), "rule-candidates")
    events = found.unionByName(found.where("type = 'impact_hit'").withColumn("type", F.lit("no_drop_plateau")))
    names = F.array(*[F.lit(x) for x in CHARACTERS])
    events = events.withColumns({"event_key": F.concat_ws(":", "type", F.col("first_idx").cast("string")), "section_character": F.element_at(names, (F.coalesce("section", F.lit(0)) % 4 + 1).cast("int"))})
    return refine.refine_candidates(events, rows, DAY, DAY, HOUR).select(E, "event_key", "refined", "refined_confidence")


def _case(kind: str, when: str, start: str, end: str, sure: str, strength: str, key: str, source: str) -> str:
    return f"SELECT entity_id, {key}, '{kind}' AS type, {start} AS start_t, {end} AS end_t, round({_one(sure)} + 1e-9::DOUBLE, 6) AS confidence, round({_one(strength)} + 1e-9::DOUBLE, 6) AS intensity FROM {source} WHERE {when}"


@query(
    "phrase_events",
    f"""WITH {DERIVED}, ph AS (SELECT phr.entity_id, phr.phrase, phr.phrase % 5 AS phrase_group, phr.s AS start_t, phr.e AS end_t, sec.s AS section_start FROM phr JOIN sec ON sec.entity_id = phr.entity_id AND sec.section = phr.phrase // 2),
c AS (SELECT entity_id, phrase_group, count(*) AS repeats FROM ph GROUP BY 1, 2), {_means('ph', 'm', 'phrase', 'w.start_t', 'w.end_t', {'vocal': 'z_vocal_presence', 'energy': 'energy_score_local'})},
j AS (SELECT ph.*, repeats, vocal, energy FROM ph JOIN m USING (entity_id, phrase) JOIN c USING (entity_id, phrase_group))
{_case('hook_phrase', 'repeats >= 2 AND vocal >= 0.35::DOUBLE', 'start_t', 'end_t', 'vocal * 0.35::DOUBLE + energy * 0.2::DOUBLE + 0.4::DOUBLE', 'greatest(vocal, energy)', 'phrase', 'j')} UNION ALL
{_case('anthem_call', f'vocal >= 0.5::DOUBLE AND energy >= 0.45::DOUBLE AND start_t - section_start <= {12 * HOUR}', 'start_t', 'end_t', 'vocal * 0.35::DOUBLE + energy * 0.2::DOUBLE + 0.4::DOUBLE', 'greatest(vocal, energy)', 'phrase', 'j')}""",
)
def phrase_events(spark, sf_dir):
    tracks = tracks_of(beats_of(spark, sf_dir))
    starts = tracks.sections.select(E, "section", F.col("start_t").alias("section_start"))
    phrases = tracks.phrases.withColumns({"phrase_group": F.col("phrase") % 5, "section": F.floor(F.col("phrase") / 2).cast("long")}).join(starts, [E, "section"]).drop("section")
    return refine.phrase_events(phrases, derived_rows(spark, sf_dir), DAY, 12 * HOUR)


@query(
    "lyric_events",
    f"""WITH {DERIVED}, li AS (SELECT entity_id, event_id AS line, t AS start_t, t + (k + 1) * {20 * MINUTE} AS end_t, k / 100::DOUBLE AS line_confidence FROM en WHERE label = 'signup'),
{_means('li', 'm', 'line', 'w.start_t', 'w.end_t', {'vocals': 'z_vocals_stem', 'focus': 'vocal_focus', 'drums': 'z_drums_stem', 'bed': 'instrumental_focus'})}, {_means('li', 'x', 'line', 'w.end_t', f'w.end_t + {6 * HOUR}', {'vocals': 'z_vocals_stem', 'harmonic': 'z_harmonic_stem', 'drums': 'z_drums_stem'}, 'next_')},
j AS (SELECT li.*, vocals, focus, drums, bed, coalesce(next_n, 0) AS next_n, next_last_t, coalesce(next_vocals, 0) AS next_vocals, coalesce(next_harmonic, 0) AS next_harmonic, coalesce(next_drums, 0) AS next_drums FROM li JOIN m USING (entity_id, line) LEFT JOIN x USING (entity_id, line)),
u AS ({_case('vocal_spotlight', 'vocals >= 0.32::DOUBLE AND focus >= 0.32::DOUBLE AND (vocals >= drums OR line_confidence >= 0.7::DOUBLE)', 'start_t', 'end_t', 'focus * 0.35::DOUBLE + vocals * 0.2::DOUBLE + least(0.12::DOUBLE, line_confidence * 0.12::DOUBLE) + 0.42::DOUBLE', 'greatest(vocals, focus)', 'line', 'j')} UNION ALL
{_case('vocal_tail', 'next_n > 0 AND focus >= 0.34::DOUBLE AND vocals - next_vocals >= 0.18::DOUBLE AND greatest(next_harmonic, next_drums, bed) >= 0.12::DOUBLE', 'end_t', 'next_last_t', '(vocals - next_vocals) * 0.55::DOUBLE + least(0.1::DOUBLE, line_confidence * 0.1::DOUBLE) + 0.42::DOUBLE', 'vocals - next_vocals', 'line', 'j')})
SELECT u.* FROM u WHERE NOT EXISTS (SELECT 1 FROM li WHERE li.entity_id = u.entity_id AND li.start_t = u.start_t AND li.end_t = u.end_t AND li.line % 7 = 0 AND u.type = 'vocal_spotlight')""",
)
def lyric_events(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    lines = rows.where("label = 'signup'").select(E, F.col("event_id").alias("line"), F.col("t").alias("start_t"), (F.col("t") + (F.col("k") + 1) * (20 * MINUTE)).alias("end_t"), (F.col("k") / F.lit(100.0)).alias("line_confidence"))
    known = lines.where("line % 7 = 0").select(E, "start_t", "end_t", F.lit("vocal_spotlight").alias("type"))
    return refine.lyric_events(lines, derived_rows(spark, sf_dir), known, DAY, 6 * HOUR)


@query(
    "hint_events",
    f"""WITH {DERIVED}, hi AS (SELECT entity_id, event_id AS hint, t AS start_t, t + (k % 20) * {HOUR} AS end_t, lower([{', '.join(f"'{h}'" for h in HINTS)}][k % 6 + 1]) AS text FROM en WHERE label = 'error' AND k % 20 > 0),
{_means('hi', 'm', 'hint', 'w.start_t', 'w.end_t', {'drums': 'z_drums_stem', 'vocals': 'z_vocals_stem', 'harmonic': 'z_harmonic_stem', 'percussion': 'percussion_focus', 'bed': 'instrumental_focus'})}, {_means('hi', 'x', 'hint', f'(w.start_t - {DAY})', 'w.start_t', {'focus': 'vocal_focus'}, 'before_')},
j AS (SELECT hi.*, drums, vocals, harmonic, percussion, bed, coalesce(before_focus, 0) AS before_focus FROM hi JOIN m USING (entity_id, hint) LEFT JOIN x USING (entity_id, hint))
{_case('percussion_break', '(' + ' OR '.join(f"contains(text, '{w}')" for w in refine.PERCUSSION_WORDS) + ') AND drums >= 0.28::DOUBLE AND percussion >= 0.08::DOUBLE AND vocals <= 0.3::DOUBLE', 'start_t', 'end_t', 'drums * 0.25::DOUBLE + percussion * 0.6::DOUBLE + 0.45::DOUBLE', 'greatest(drums, percussion)', 'hint', 'j')} UNION ALL
{_case('vocal_tail', '(' + ' OR '.join(f"contains(text, '{w}')" for w in refine.ENDING_WORDS) + ') AND before_focus >= 0.35::DOUBLE AND before_focus - vocals >= 0.12::DOUBLE AND greatest(harmonic, bed, drums) >= 0.12::DOUBLE', 'start_t', 'end_t', '(before_focus - vocals) * 0.8::DOUBLE + 0.45::DOUBLE', 'before_focus - vocals', 'hint', 'j')}""",
)
def hint_events(spark, sf_dir):
    rows, k = beats_of(spark, sf_dir), F.col("k")
    names = F.array(*[F.lit(h) for h in HINTS])
    hints = rows.where("label = 'error'").select(E, F.col("event_id").alias("hint"), F.col("t").alias("start_t"), (F.col("t") + k % 20 * HOUR).alias("end_t"), F.element_at(names, (k % 6 + 1).cast("int")).alias("text"))
    none = hints.where("false").select(E, "start_t", "end_t", F.lit("").alias("type"))
    return refine.hint_events(hints, derived_rows(spark, sf_dir), none, DAY, DAY)
