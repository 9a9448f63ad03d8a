"""Queries of event records: documents, their metrics, and documents after refinement, each held against its contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts, event_records, refine, rule_events
from ..sources.tables import artifact
from .feature_queries import CANDIDATES, DAY, STATES, _U, beats_of, rule_rows, tracks_of
from .refine_queries import _DROP, _HELD, _PLATEAU, CHARACTERS, _means, _top, _variant
from .registry import HOUR, query
from .timeline_queries import E


def _six(x: str) -> str:
    return f"round({x} + 1e-9::DOUBLE, 6)"


def _bound(threshold: str | int) -> str:
    return _six(f"{threshold} {_U}" if isinstance(threshold, str) else f"{threshold / 1_000_000}::DOUBLE")


#: What each record quotes, in SQL, by type.
_VALUES = {
    "build": [f"a_energy {_U}", f"a_tension {_U}"], "breakdown": [f"a_delta {_U}", f"a_density {_U}"], "drop": [f"{x} {_U}" for x in ("energy_delta", "z_onset", "z_bass_activation", "z_accent_intensity")], "impact_hit": [f"z_accent_intensity {_U}"],
    "pause_break": [f"silence_gap {_U}", f"z_energy_score {_U}"], "fake_drop": [f"tension_local {_U}"], "groove_loop": [f"{x} {_U}" for x in ("energy", "bass", "volatility")], "atmospheric_plateau": [f"energy {_U}", f"onset {_U}"], "tension_hold": [f"tension {_U}"], "no_drop_plateau": [f"energy {_U}", f"tension {_U}"],
}
_ALSO = {"build": f"greatest(0::DOUBLE, a_tension {_U} - 0.1::DOUBLE)", "drop": f"least(1::DOUBLE, z_accent_intensity {_U} + 0.1::DOUBLE)", "pause_break": f"least(0.95::DOUBLE, tension_local {_U})", "fake_drop": "0.5::DOUBLE"}
_RECORDS = event_records.ROW_RECORDS | event_records.SECTION_RECORDS


def _metrics(kind: str) -> str:
    parts = [f"{{'name': '{m.name}', 'value': {_six(v)}, 'threshold': {_bound(m.threshold)}, 'comparator': '{m.comparator}'}}" for m, v in zip(_RECORDS[kind].metrics, _VALUES[kind])]
    return f"WHEN '{kind}' THEN [{', '.join(parts)}]"


_NAMES = ", ".join(f"'{c}'" for c in CHARACTERS)
RECORDS = f"""{CANDIDATES}, {STATES}, un AS (SELECT * FROM events_ UNION ALL SELECT * FROM states),
idd AS (SELECT *, 'rule_' || type || printf('_%03d', row_number() OVER (PARTITION BY entity_id, type ORDER BY start_t, first_idx)) AS id FROM un),
mn AS (SELECT i.entity_id, i.id, round(sum(energy_score_local)::DOUBLE / count(*)) AS a_energy, round(sum(tension_local)::DOUBLE / count(*)) AS a_tension, round(sum(energy_delta)::DOUBLE / count(*)) AS a_delta, round(sum(density_delta)::DOUBLE / count(*)) AS a_density FROM idd i JOIN f ON f.entity_id = i.entity_id AND f.idx BETWEEN i.first_idx AND i.last_idx WHERE type IN ('build', 'breakdown') GROUP BY 1, 2),
fr AS (SELECT entity_id, idx AS first_idx, energy_delta, z_onset, z_bass_activation, z_accent_intensity, z_energy_score, silence_gap, tension_local, {', '.join(f'th_{n}' for n in rule_events.DYNAMIC)} FROM f),
cd AS (SELECT entity_id, section, energy, onset, bass, tension, volatility FROM both_),
rec AS (SELECT * FROM idd LEFT JOIN mn USING (entity_id, id) JOIN fr USING (entity_id, first_idx) LEFT JOIN cd USING (entity_id, section) LEFT JOIN (SELECT entity_id, section, s, e FROM sec) USING (entity_id, section))"""


def records_of(spark, sf_dir):
    rows = rule_rows(spark, sf_dir)
    found = artifact(rule_events.rule_candidates(rows, release_within=2 * DAY), "rule-candidates")
    sections = tracks_of(beats_of(spark, sf_dir)).sections.withColumn("section_character", F.element_at(F.array(*[F.lit(x) for x in CHARACTERS]), (F.col("section") % 4 + 1).cast("int")))
    return rows, artifact(event_records.rule_records(found, rule_events.section_candidates(rows, found), sections), "rule-records")


def _problems(records, record, key):
    """How many codes the contract gives each document; all are 0 if the records are right."""
    wrong = contracts.check_documents(event_records.as_documents(records, record, key).select(F.concat_ws("/", E, key).alias("key"), "document"), contracts.EVENT, "event", "key")
    counted = wrong.groupBy("key").agg(F.count("*").alias("problems"))
    return records.withColumn("_key", F.concat_ws("/", E, key)).join(counted, F.col("_key") == F.col("key"), "left").fillna(0, ["problems"])


@query(
    "event_documents",
    f"""WITH {RECORDS} SELECT entity_id, id, type, round(start_t / 1000000::DOUBLE, 6) AS start_time, round(end_t / 1000000::DOUBLE, 6) AS end_time, confidence, intensity, 'beats:' || first_idx || '-' || last_idx AS ref, CASE WHEN section IS NOT NULL THEN printf('section-%03d', section + 1) END AS section_id,
  CASE WHEN section IS NOT NULL THEN round(e / 1000000::DOUBLE, 6) END AS section_end, CASE WHEN section IS NOT NULL THEN [{_NAMES}][section % 4 + 1] END AS section_name, CASE type {' '.join(f"WHEN '{k}' THEN '{r.rule}'" for k, r in _RECORDS.items())} END AS rule_name,
  CASE type {' '.join(f"WHEN '{k}' THEN '{r.also[0]}'" for k, r in _RECORDS.items() if r.also)} END AS also_type, CASE type {' '.join(f"WHEN '{k}' THEN {_six(f'greatest(0::DOUBLE, least(1::DOUBLE, {v}))')}" for k, v in _ALSO.items())} END AS also_confidence, 0 AS problems FROM rec""",
)
def event_documents(spark, sf_dir):
    _, records = records_of(spark, sf_dir)
    r = F.col("record")
    return _problems(records, "record", "id").select(
        E, "id", "type", r.start_time.alias("start_time"), r.end_time.alias("end_time"), r.confidence.alias("confidence"), r.intensity.alias("intensity"), F.get(r.evidence.source_windows, F.lit(0)).ref.alias("ref"), r.section_id.alias("section_id"), F.get(r.evidence.source_windows, F.lit(1)).end_time.alias("section_end"),
        r.section_name.alias("section_name"), F.get(r.evidence.rule_names, F.lit(0)).alias("rule_name"), F.get(r.candidates, F.lit(0)).type.alias("also_type"), F.get(r.candidates, F.lit(0)).confidence.alias("also_confidence"), "problems",
    )


@query("event_metrics", f"WITH {RECORDS}, m AS (SELECT entity_id, id, unnest(CASE type {' '.join(map(_metrics, _RECORDS))} END, max_depth := 2) FROM rec) SELECT * FROM m")
def event_metrics(spark, sf_dir):
    _, records = records_of(spark, sf_dir)
    return records.select(E, "id", F.explode("record.evidence.metrics").alias("m")).select(E, "id", "m.name", "m.value", "m.threshold", "m.comparator")


def _ranked(scores: dict[str, str], p: str) -> str:
    return f"list_sort([{', '.join(f'''(-{p}{i}, {i}, '{n}')''' for i, n in enumerate(scores))}])[1]"


@query(
    "refined_documents",
    f"""WITH {RECORDS}, ev AS (SELECT *, id AS event_key, coalesce([{_NAMES}][section % 4 + 1], '') AS section_character, type = 'drop' AND first_idx % 2 = 0 AS identified, CASE WHEN type = 'drop' AND first_idx % 2 = 0 THEN least(1::DOUBLE, first_idx % 300 / 200::DOUBLE) ELSE 0 END AS spectral_rise FROM idd),
{_means('ev', 'h', 'event_key', 'w.start_t', 'w.end_t', _HELD)}, {_means('ev', 'x', 'event_key', 'w.end_t', f'w.end_t + {DAY}', {'rise': 'greatest(0, energy_delta)'}, 'next_')},
j AS (SELECT ev.*, coalesce(n, 0) AS n, {', '.join(f'coalesce({m}, 0) AS {m}' for m in _HELD)}, coalesce(next_rise, 0) AS rise FROM ev LEFT JOIN h USING (entity_id, event_key) LEFT JOIN x USING (entity_id, event_key)),
s AS (SELECT *, {_top(_DROP, 'd')}, {_top(_PLATEAU, 'p')} FROM j), v AS (SELECT *, {_variant(_DROP, 'd', 0.62, 0.05)}, {_variant(_PLATEAU, 'p', 0.55, 0.04)}, type IN ('breakdown', 'pause_break') AND rise >= 0.18::DOUBLE AS reset, {_ranked(_DROP, 'd')} AS dr, {_ranked(_PLATEAU, 'p')} AS pr FROM s),
q AS (SELECT *, CASE WHEN n > 0 AND type = 'drop' THEN coalesce(dv, type) WHEN n > 0 AND type = 'no_drop_plateau' THEN coalesce(pv, type) WHEN reset THEN 'energy_reset' ELSE type END AS refined, row_number() OVER (PARTITION BY entity_id ORDER BY start_t, end_t, type, first_idx) AS number FROM v)
SELECT entity_id, id AS rule_id, 'machine_' || refined || printf('_%03d', number) AS id, refined AS type, round(CASE WHEN type = 'drop' AND n > 0 THEN least(1::DOUBLE, confidence + (dt - 0.5::DOUBLE) * 0.15::DOUBLE) WHEN type = 'no_drop_plateau' AND n > 0 THEN least(1::DOUBLE, greatest(confidence, pt * 0.9::DOUBLE)) WHEN reset THEN least(1::DOUBLE, greatest(confidence, rise * 0.5::DOUBLE + 0.55::DOUBLE)) ELSE confidence END + 1e-9::DOUBLE, 6) AS confidence,
  {_six('greatest(0::DOUBLE, least(1::DOUBLE, intensity))')} AS intensity, CASE WHEN n > 0 AND type = 'drop' THEN dr[3] WHEN n > 0 AND type = 'no_drop_plateau' THEN pr[3] WHEN reset THEN 'energy_reset' END AS best_type,
  CASE WHEN n > 0 AND type = 'drop' THEN -dr[1] WHEN n > 0 AND type = 'no_drop_plateau' THEN -pr[1] WHEN reset THEN {_six('least(1::DOUBLE, rise + 0.55::DOUBLE)')} END AS best_confidence, CASE WHEN n > 0 AND type = 'drop' THEN 4 WHEN n > 0 AND type = 'no_drop_plateau' THEN 3 WHEN reset THEN 2 ELSE 0 END AS n_candidates,
  CASE WHEN identified THEN 3 ELSE 2 END AS n_layers, 0 AS problems FROM q""",
)
def refined_documents(spark, sf_dir):
    rows, records = records_of(spark, sf_dir)
    identifiers = records.where("type = 'drop' and first_idx % 2 = 0").select(E, "id", (F.col("first_idx") % 300).alias("spectral_centroid_delta"))
    events = records.withColumn("section_character", F.coalesce("section_character", F.lit("")))
    refined = refine.refine_candidates(events, rows, DAY, DAY, HOUR, key="id", identifiers=identifiers)
    made = artifact(event_records.refined_records(refined).select(E, F.col("id").alias("rule_id"), F.col("refined_id"), "refined_record"), "refined-records")
    r = F.col("refined_record")
    best = F.get(r.candidates, F.lit(0))
    return _problems(made, "refined_record", "refined_id").select(
        E, "rule_id", F.col("refined_id").alias("id"), r.type.alias("type"), r.confidence.alias("confidence"), r.intensity.alias("intensity"), best.type.alias("best_type"), best.confidence.alias("best_confidence"), F.coalesce(F.size(r.candidates), F.lit(0)).alias("n_candidates"), F.size(r.source_layers).alias("n_layers"), "problems",
    )
