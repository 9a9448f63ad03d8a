"""Event records: rule candidates and refined events as documents with ids, evidence, notes and candidates.

What a record of each type says is data: a summary, a rule, notes, the metrics that it quotes, and the reading that it
may also have. Records are structs built in one pass; as JSON they meet the event contract.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rule_events
from .rule_events import HALF_UP, clamped, share
from .windows import ENTITY

Value = Callable[[], Column]
#: Metrics named by windows of the feature and the section layer. Fixed values.
FEATURE_METRICS, SECTION_METRICS = ["energy_score", "symbolic_density", "harmonic_tension_proxy"], ["section_character", "confidence"]
RULE_ENGINE, CLASSIFIER = "analyzer_rule_engine", "analyzer_event_classifier"
LAYERS = ["event_features", "sections"]


@dataclass
class Metric:
    """A quoted value, the threshold it was held against (a column of the event's row, or a number in millionths), and how."""

    name: str
    value: Value
    threshold: str | int
    comparator: str = ">="


@dataclass
class Record:
    """What records of a type say; ``also`` is another reading: its type, confidence and notes."""

    summary: str
    rule: str
    notes: str
    metrics: list[Metric] = field(default_factory=list)
    also: tuple[str, Value, str] | None = None


def _a() -> Column:
    return share(F.col("a"))


def _b() -> Column:
    return share(F.col("b"))


def _of(name: str) -> Value:
    return lambda: share(F.col(f"row.{name}"))


#: Records of rows' events. Texts and names are fixed values.
ROW_RECORDS = {
    "build": Record("Rising short-window energy and harmonic tension indicate an obvious build phase.", "build_energy_rise", "Merged consecutive build anchors to preserve the multi-beat rise window.", [Metric("energy_mean", _a, "th_build_energy"), Metric("harmonic_tension_mean", _b, "th_build_tension")], ("tension_hold", lambda: F.greatest(F.lit(0.0), _b() - 0.1), "High tension may also read as a held-state.")),
    "breakdown": Record("Energy and symbolic density both drop sharply across this window.", "breakdown_dual_drop", "Breakdown candidates are merged across adjacent negative-delta beats.", [Metric("energy_delta", _a, "th_breakdown_energy_delta", "<="), Metric("density_delta", _b, rule_events.BREAKDOWN_DENSITY_DELTA, "<=")]),
    "drop": Record("Synchronized rise in energy, onset activity, bass activation, and accent intensity indicates a baseline drop.", "drop_energy_release", "Baseline drop candidate without subtype refinement.", [Metric("energy_delta", _of("energy_delta"), "th_drop_energy_delta"), Metric("onset_density", _of("z_onset"), rule_events.DROP_ONSET), Metric("bass_activation", _of("z_bass_activation"), rule_events.DROP_BASS), Metric("accent_intensity", _of("z_accent_intensity"), rule_events.DROP_ACCENT)], ("impact_hit", lambda: F.least(F.lit(1.0), _of("z_accent_intensity")() + 0.1), "Short accent overlap suggests an impact reading too.")),
    "impact_hit": Record("Accent intensity crosses the impact threshold on this beat.", "impact_accent_peak", "Impact hits remain single-beat candidates.", [Metric("accent_intensity", _a, rule_events.IMPACT_ACCENT)]),
    "pause_break": Record("Silence gap duration and low energy indicate a pause or stop-time break.", "pause_gap_low_energy", "Pause candidates are kept even when they may precede a later release.", [Metric("silence_gap_seconds", lambda: F.col("a"), rule_events.PAUSE_GAP), Metric("energy_score", _b, rule_events.PAUSE_ENERGY, "<=")], ("fake_drop", lambda: F.least(F.lit(0.95), _of("tension_local")()), "Held tension may resolve to a fake drop instead of a true pause.")),
    "fake_drop": Record("A pause-like break holds tension but is not followed by a qualifying drop window.", "fake_drop_unresolved_pause", "Fake-drop candidates remain separate from pause_break for review.", [Metric("harmonic_tension_mean", _a, "th_fake_drop_tension")], ("pause_break", lambda: F.lit(0.5), "Window also satisfies the baseline pause rule.")),
}
#: Records of sections' states.
SECTION_RECORDS = {
    "groove_loop": Record("Stable section energy and bass activation indicate a sustained groove-loop state.", "groove_loop_section_state", "Section-level sustained-state candidate.", [Metric("energy_mean", _of("energy"), "th_groove_energy"), Metric("bass_mean", _of("bass"), rule_events.GROOVE_BASS), Metric("energy_volatility", _of("volatility"), rule_events.GROOVE_VOLATILITY, "<=")]),
    "atmospheric_plateau": Record("Low-energy low-motion section profile indicates an atmospheric plateau.", "atmospheric_plateau_section_state", "Section-level held-state candidate.", [Metric("energy_mean", _of("energy"), "th_atmo_energy", "<="), Metric("onset_mean", _of("onset"), rule_events.ATMO_ONSET, "<=")]),
    "tension_hold": Record("Sustained harmonic tension stays elevated across the section without a qualifying release.", "tension_hold_section_state", "Held-state candidate preserved even when overlapping build windows exist.", [Metric("tension_mean", _of("tension"), "th_hold_tension")]),
    "no_drop_plateau": Record("Build evidence is present, but the section settles into a plateau without a qualifying drop.", "no_drop_plateau_unresolved_build", "Unresolved-release candidate preserved for later identifier review.", [Metric("energy_mean", _of("energy"), rule_events.NO_DROP_ENERGY[0]), Metric("tension_mean", _of("tension"), "th_hold_tension")]),
}


def _six(x: Column) -> Column:
    return F.round(x + HALF_UP, 6)


def described(events: DataFrame, records: dict[str, Record]) -> DataFrame:
    """events of these types with summary, rule_names, notes, metrics and candidates; the columns a, b and row go."""

    def pick(what: Callable[[Record], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("type") == kind, what(r)) for kind, r in records.items()])

    def metric(m: Metric) -> Column:
        bound = share(F.col(f"row.{m.threshold}")) if isinstance(m.threshold, str) else F.lit(m.threshold / 1_000_000)
        return F.struct(F.lit(m.name).alias("name"), _six(m.value()).alias("value"), _six(bound).alias("threshold"), F.lit(m.comparator).alias("comparator"), F.lit("event_features").alias("source_layer"))

    def also(r: Record) -> Column:
        none = F.lit(None).cast("array<struct<type:string,confidence:double,notes:string>>")
        return F.array(F.struct(F.lit(r.also[0]).alias("type"), clamped(r.also[1]()).alias("confidence"), F.lit(r.also[2]).alias("notes"))) if r.also else none

    return events.select(
        *rule_events.EVENT, pick(lambda r: F.lit(r.summary)).alias("summary"), pick(lambda r: F.array(F.lit(r.rule))).alias("rule_names"), pick(lambda r: F.lit(r.notes)).alias("notes"), pick(lambda r: F.array(*[metric(m) for m in r.metrics])).alias("metrics"), pick(also).alias("candidates")
    )


def rule_records(rows_events: DataFrame, section_events: DataFrame, sections: DataFrame, unit: float = 1e6) -> DataFrame:
    """Records of rule candidates and section states: the event's columns, ``id`` (numbered by type in time order), and
    ``record``, the document as a struct. sections: entity_id, section, start_t, end_t, section_character. Events in no section
    name none."""
    both = described(rows_events, ROW_RECORDS).unionByName(described(section_events, SECTION_RECORDS))
    number = F.row_number().over(Window.partitionBy(ENTITY, "type").orderBy("start_t", "first_idx"))
    named = both.withColumn("id", F.format_string("rule_%s_%03d", "type", number))
    place = sections.select(F.col(ENTITY).alias("_e"), F.col("section").alias("_of"), F.col("start_t").alias("_s"), F.col("end_t").alias("_t"), "section_character")
    placed = named.join(place, (F.col(ENTITY) == F.col("_e")) & (F.col("section") == F.col("_of")), "left")
    seconds = lambda c: F.round(F.col(c) / unit, 6)
    section_id = F.format_string("section-%03d", F.col("_of") + 1)
    window = lambda layer, start, end, ref, names: F.struct(F.lit(layer).alias("layer"), start.alias("start_time"), end.alias("end_time"), ref.alias("ref"), F.array(*[F.lit(n) for n in names]).alias("metric_names"))
    windows = F.array_compact(F.array(
        window("event_features", seconds("start_t"), seconds("end_t"), F.format_string("beats:%d-%d", "first_idx", "last_idx"), FEATURE_METRICS),
        F.when(F.col("_of").isNotNull(), window("sections", seconds("_s"), seconds("_t"), section_id, SECTION_METRICS)),
    ))
    evidence = F.struct("summary", windows.alias("source_windows"), "metrics", F.array("summary").alias("reasons"), "rule_names")
    there = F.col("_of").isNotNull()
    record = F.struct(
        "id", "type", F.lit(RULE_ENGINE).alias("created_by"), seconds("start_t").alias("start_time"), seconds("end_t").alias("end_time"), F.col("confidence"), F.col("intensity"), evidence.alias("evidence"), "notes",
        F.array(*[F.lit(x) for x in LAYERS]).alias("source_layers"), F.when(there, section_id).alias("section_id"), F.col("section_character").alias("section_name"), "candidates",
    )
    return placed.select(*rule_events.EVENT, "id", F.col("section_character"), record.alias("record"))


def refined_records(refined: DataFrame) -> DataFrame:
    """refined events (as of refine_candidates, with ``record``, the rule's) with ``refined_id`` and ``refined_record``: type, confidence, intensity,
    candidates and notes after refinement. Ids count an entity's events in order of start, end and type. Drops that an identifier
    tells of name its layer."""
    c = F.col
    number = F.row_number().over(Window.partitionBy(ENTITY).orderBy("start_t", "end_t", "type", "first_idx"))
    opened = F.when(c("identified") & (c("type") == "drop"), F.array_union(c("record.source_layers"), F.array(F.lit("energy_identifiers")))).otherwise(c("record.source_layers"))
    changes = {
        "id": F.format_string("machine_%s_%03d", c("refined"), number), "type": c("refined"), "created_by": F.lit(CLASSIFIER), "confidence": c("refined_confidence"), "intensity": c("refined_intensity"),
        "notes": F.concat_ws(" ", "record.notes", "note"), "source_layers": opened, "candidates": c("candidates"),
    }
    record = c("record")
    for name, value in changes.items():
        record = record.withField(name, value)
    return refined.withColumn("refined_record", record).withColumn("refined_id", c("refined_record.id"))


def as_documents(records: DataFrame, record: str = "record", key: str = "id") -> DataFrame:
    """(entity_id, key, document): records as JSON; fields without a value are left out."""
    return records.select(ENTITY, key, F.to_json(record).alias("document"))
