"""JSON contracts as data: shapes of objects, checked as column expressions over VARIANT values.

A shape lists its fields; checking a document gives the codes of all that is wrong, so a table of documents
becomes a table of violations in one pass, without Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import canonical_label

#: Event types and their other names. Fixed values.
VOCABULARY = {
    "build": ["build_up", "build-up", "build up", "buildup"],
    "breakdown": ["break_down", "break-down", "break down"],
    "drop": ["release", "main_drop", "main-drop"],
    "drop_explode": ["explosive_drop", "explosive-drop"],
    "drop_groove": ["groove_drop", "groove-drop"],
    "drop_punch": ["punch_drop", "punch-drop"],
    "soft_release": ["soft_drop", "soft-drop", "gentle_release"],
    "no_drop_plateau": ["plateau_release", "plateau-release", "no_drop"],
    "fake_drop": ["fake_out", "fake-out", "fakeout"],
    "tension_hold": ["hold_tension", "hold-tension"],
    "pause_break": ["pause", "stop_time", "stop-time"],
    "anthem_call": ["vocal_call", "crowd_call", "anthem-call"],
    "call_response": ["call-and-response", "call_and_response"],
    "hook_phrase": ["hook-phrase", "hook_phrase_repeat"],
    "vocal_spotlight": ["vocal-focus", "voice_spotlight", "voice-focus"],
    "vocal_tail": ["vocal-decay", "voice_tail", "voice-decay"],
    "energy_reset": ["reset", "release_reset", "release-reset"],
    "layer_add": ["add_layer", "add-layer", "layer-in"],
    "layer_remove": ["remove_layer", "remove-layer", "layer-out"],
    "impact_hit": ["impact", "impact-hit", "downbeat_hit"],
    "stinger": ["sting", "one_shot", "one-shot"],
    "groove_loop": ["groove-loop", "loop_groove"],
    "atmospheric_plateau": ["atmospheric-plateau", "ambient_plateau"],
    "percussion_break": ["drum_break", "percussion-break", "drum-only"],
    "instrumental_bed": ["instrumental-bed", "instrumental_plateau", "music_bed"],
    "heartbeat_pattern": ["pulse_heart", "heart-beat"],
    "four_on_the_floor": ["straight_four", "driving_kick"],
}
#: Layers that evidence and events may name, states of an override, and the version of payloads. Fixed values.
LAYERS = ["timing", "sections", "harmonic", "symbolic", "energy", "genre", "event_features", "rule_candidates", "energy_identifiers", "event_machine", "event_review", "user_override"]
OVERRIDES = ["confirmed", "deleted", "retimed", "relabeled", "annotated"]
SCHEMA_VERSION = "1.0"

KINDS = {"string": r"^STRING", "number": r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)", "boolean": r"^BOOLEAN", "list": r"^ARRAY", "object": r"^OBJECT"}


@dataclass
class Field:
    """A field of a shape: its kind, whether it must be there, the values or range it takes, and the shape of
    the object or of the list's members. ``check`` is a further condition on a string."""

    kind: str
    required: bool = False
    values: list[str] | None = None
    low: float | None = None
    high: float | None = None
    shape: Shape | None = None
    members: str | None = None
    check: Callable[[Column], Column] | None = None


@dataclass
class Shape:
    """Fields by name, pairs of numbers that must be in order, and fields of which one must be populated."""

    fields: dict[str, Field]
    ordered: list[tuple[str, str]] = field(default_factory=list)
    any_of: list[str] = field(default_factory=list)


def normal_type(label: Column) -> Column:
    """The event type that a label or one of its other names stands for; null for none."""
    names = {alias: name for name, aliases in VOCABULARY.items() for alias in [name, *aliases]}
    plain = {"_".join(a.strip().casefold().replace("-", " ").split()): n for a, n in names.items()}
    table = F.create_map(*[F.lit(x) for pair in sorted(plain.items()) for x in pair])
    return F.try_element_at(table, canonical_label(label))


def known_type(label: Column) -> Column:
    """Whether a label stands for an event type; one spelled as in the vocabulary is not brought into its plain form first."""
    spelled = {alias for name, aliases in VOCABULARY.items() for alias in [name, *aliases]}
    plain = {"_".join(a.strip().casefold().replace("-", " ").split()) for a in spelled}
    return F.coalesce(label.isin(sorted(spelled | plain)) | canonical_label(label).isin(sorted(plain)), F.lit(False))


text, number, truth, thing = Field("string"), Field("number"), Field("boolean"), Field("object")
need = lambda f: Field(f.kind, True)
SOURCE_WINDOW = Shape({"layer": Field("string", True, LAYERS), "start_time": need(number), "end_time": need(number), "ref": text, "metric_names": Field("list", members="string"), "notes": text}, [("start_time", "end_time")])
METRIC = Shape({"name": need(text), "value": need(number), "unit": text, "threshold": number, "comparator": text, "source_layer": Field("string", values=LAYERS), "notes": text})
MODEL = Shape({"name": need(text), "version": text, "confidence_delta": number, "notes": text})
_EVIDENCE = {"summary": text, "source_windows": Field("list", shape=SOURCE_WINDOW), "metrics": Field("list", shape=METRIC), "reasons": Field("list", members="string"), "rule_names": Field("list", members="string"), "model": Field("object", shape=MODEL)}
EVIDENCE = Shape(_EVIDENCE | {"metadata": thing}, any_of=list(_EVIDENCE))
OVERRIDE = Shape({"status": Field("string", True, OVERRIDES), "editor": text, "reason": text, "updated_type": Field("string", check=known_type), "updated_start_time": number, "updated_end_time": number, "notes": text}, [("updated_start_time", "updated_end_time")])
LIGHTING = Shape({"cue_style": text, "energy_profile": text, "notes": text, "editable": truth})
CANDIDATE = Shape({"type": Field("string", True, check=known_type), "confidence": Field("number", True, low=0, high=1), "notes": text})
EVENT = Shape(
    {
        "id": need(text), "type": Field("string", True, check=known_type), "start_time": need(number), "end_time": need(number), "confidence": Field("number", True, low=0, high=1), "intensity": Field("number", True, low=0, high=1),
        "evidence": Field("object", True, shape=EVIDENCE), "notes": need(text), "created_by": text, "section_name": text, "section_id": text, "source_layers": Field("list", members="string", values=LAYERS), "human_override": Field("object", shape=OVERRIDE), "lighting_hints": Field("object", shape=LIGHTING),
        "candidates": Field("list", shape=CANDIDATE), "metadata": thing,
    },
    [("start_time", "end_time")],
)
PAYLOAD = Shape({"schema_version": Field("string", True, [SCHEMA_VERSION]), "song_name": need(text), "generated_from": need(thing), "events": Field("list", True, shape=EVENT), "review_status": text, "notes": text, "threshold_profile": text, "metadata": thing})


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, a list; the value is worked out once for a row, however often the body names it."""
    return F.flatten(F.transform(F.array(value), body))


def _as_object(value: Column) -> Column:
    """An object's fields by name; null for what is no object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _is(kind: Column, name: str) -> Column:
    return kind.rlike(KINDS[name]) if name == "number" else kind == KINDS[name].lstrip("^")


def _opened(fields: Column, shape: Shape) -> Column:
    """Of each field that a shape lists what its checks ask more than once: the members of a list, the fields of an object, else the kind."""

    def of(part: Column, f: Field) -> Column:
        if f.kind == "list":
            return F.try_variant_get(part, "$", "array<variant>")
        return _as_object(part) if f.kind == "object" else F.schema_of_variant(part)

    return F.struct(*[of(fields[key], f).alias(key) for key, f in shape.fields.items()])


def _member_codes(members: Column, f: Field, path: str) -> list[Column]:
    """Codes of the members of a list, as columns of lists."""
    if f.shape:
        return [F.flatten(F.transform(members, lambda m: _problems(_as_object(m), f.shape, path)))]
    found = []
    if f.members:
        kind = lambda m: F.coalesce(_is(F.schema_of_variant(m), f.members), F.lit(False))
        found.append((F.exists(members, lambda m: ~kind(m)), f"{path}:kind"))
        if f.values:
            found.append((F.exists(members, lambda m: kind(m) & ~F.try_variant_get(m, "$", "string").isin(f.values)), f"{path}:value"))
    return [_codes(*found)]


def _codes(*found: tuple[Column, str]) -> Column:
    """A code, or null, for each condition."""
    return F.array(*[F.when(bad, F.lit(code)) for bad, code in found]) if found else F.array().cast("array<string>")


def _object_codes(fields: Column, opened: Column, shape: Shape, name: str) -> Column:
    found, parts = [(F.exists(F.map_keys(fields), lambda k: ~k.isin(list(shape.fields))), f"{name}:unknown")], []
    for key, f in shape.fields.items():
        part, own, path = fields[key], opened[key], f"{name}.{key}"
        right = own.isNotNull() if f.kind in ("list", "object") else _is(own, f.kind)
        if f.required:
            found.append((part.isNull(), f"{path}:missing"))
        found.append((part.isNotNull() & ~right, f"{path}:kind"))
        plain = F.try_variant_get(part, "$", "string")
        if f.kind == "string" and f.values:
            found.append((right & ~plain.isin(f.values), f"{path}:value"))
        if f.check:
            found.append((right & ~f.check(plain), f"{path}:value"))
        if f.low is not None:
            found.append((right & ~F.try_variant_get(part, "$", "double").between(f.low, f.high), f"{path}:range"))
        if f.kind == "object" and f.shape:
            parts.append(F.when(right, _problems(own, f.shape, path)))
        if f.kind == "list":
            parts += [F.when(right, codes) for codes in _member_codes(own, f, f"{path}[]")]
    for a, b in shape.ordered:
        x, y = (F.try_variant_get(fields[c], "$", "double") for c in (a, b))
        found.append((_is(opened[a], "number") & _is(opened[b], "number") & (y < x), f"{name}:order"))
    if shape.any_of:
        # populated: there, and neither null, nor an empty list or text
        empty = F.lit(True)
        for key in shape.any_of:
            empty = empty & F.coalesce(F.to_json(fields[key]), F.lit("null")).isin("null", "[]", '""')
        found.append((empty, f"{name}:empty"))
    none = F.array().cast("array<string>")
    return F.concat(_codes(*found), *[F.coalesce(p, none) for p in parts])


def _problems(fields: Column, shape: Shape, name: str) -> Column:
    """Codes of an object's fields, nulls and repeats among them; the one code ``name:kind`` where there is no object."""
    codes = lambda m: _bound(_opened(m, shape), lambda o: _object_codes(m, o, shape, name))
    return _bound(fields, lambda m: F.when(m.isNotNull(), codes(m)).otherwise(F.array(F.lit(f"{name}:kind"))))


def problems(value: Column, shape: Shape, name: str) -> Column:
    """Codes of what is wrong with a VARIANT value: ``name:kind`` for a value that is no object,
    ``name.field:missing``, ``name:unknown``, ``name.field:kind``, ``:value``, ``:range``, ``name:order`` and
    ``name:empty``. Members of lists share the codes of their shape, each code once. Every object is taken apart once and each
    field's kind is found once, at all depths, so the work follows the length of the document."""
    return F.array_compact(F.array_distinct(_problems(_as_object(value), shape, name)))


def check_documents(documents: DataFrame, shape: Shape, name: str, key: str, text_: str = "document") -> DataFrame:
    """documents (key, JSON text) -> (key, violation), a row for each code; a text that is no JSON object has the
    one code ``name:kind``."""
    return documents.select(key, F.explode(problems(F.try_parse_json(F.col(text_)), shape, name)).alias("violation"))


def outside(rows: DataFrame, durations: DataFrame, key: str, by: str = "entity_id", start: str = "t", end: str = "end_t", slack: float = 1e-6) -> DataFrame:
    """Keys of windows that begin before 0 or end beyond the entity's duration."""
    joined = rows.join(durations.select(F.col(by).alias("_e"), F.col("duration").alias("_d")), F.col(by) == F.col("_e"))
    return joined.where((F.col(start) < 0) | (F.col(end) > F.col("_d") + slack)).select(key)
