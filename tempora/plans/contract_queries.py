"""Queries of the JSON contracts, over event documents made of the rows, most of them with faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts
from ..operators.contracts import EVENT, PAYLOAD, VOCABULARY, Shape
from .feature_queries import beats_of
from .registry import TL, query
from .timeline_queries import E

#: Parts of the documents, as SQL expressions that both engines know.
_TYPE = """CASE k % 8 WHEN 0 THEN '"Build-Up"' WHEN 1 THEN '" pause "' WHEN 2 THEN concat('"', label, '"') WHEN 3 THEN '"drop"' WHEN 4 THEN '5' ELSE '"vocal-focus"' END"""
_CONFIDENCE = """CASE k % 6 WHEN 0 THEN '1.5' WHEN 1 THEN 'true' WHEN 2 THEN '"0.5"' ELSE concat('0.', lpad(CAST(k AS {text}), 2, '0')) END"""
_EVIDENCE = [
    "{}", '{"summary": ""}', '{"summary": "x", "odd": 1}', '{"source_windows": [{"layer": "timing", "start_time": 2, "end_time": 1}, {"layer": "nowhere", "start_time": 0, "end_time": 1, "ref": 7}, 4]}',
    '{"metrics": [{"name": "a", "value": true}, {"value": 1, "source_layer": "energy", "threshold": "x"}]}', '{"model": {"version": 2}}', '{"model": {"name": "m", "confidence_delta": 0.5}, "reasons": ["a", 1]}', "[1]", '{"rule_names": [], "summary": null}', '{"summary": "fine", "metadata": {"a": 1}}',
]
_MORE = [
    ', "human_override": {"status": "gone", "updated_type": "Reset", "updated_start_time": 3, "updated_end_time": 2}', ', "lighting_hints": {"editable": "yes", "glow": 1}', ', "candidates": [{"type": "fakeout", "confidence": 2}, {"confidence": 0.1, "notes": 1}]',
    ', "source_layers": ["timing", "moon", 3]', ', "color": 1', "", "", ', "human_override": {"status": "retimed", "updated_type": "whatever"}', ', "section_name": 4, "metadata": {}',
]


def _document(text: str) -> str:
    cases = lambda values, n: "CASE event_id % " + str(n) + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"
    s = lambda x: f"CAST({x} AS {text})"
    return f"""concat('{{"id": "e', {s('event_id')}, '", "type": ', {_TYPE}, ', "start_time": ', {s('idx')}, ', "end_time": ', {s('idx + k % 5 - 1')}, ', "confidence": ', {_CONFIDENCE.format(text=text)}, ', "intensity": 0.5, "evidence": ', {cases(_EVIDENCE, 10)}, CASE WHEN event_id % 17 = 0 THEN '' ELSE ', "notes": "n"' END, {cases(_MORE, 9)}, '}}')"""


def _is_sql(v: str, kind: str) -> str:
    names = {"string": "'VARCHAR'", "number": "'BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE'", "boolean": "'BOOLEAN'", "list": "'ARRAY'", "object": "'OBJECT'"}
    return f"coalesce(json_type({v}) IN ({names[kind]}), false)"


_NAMES = sorted({"_".join(a.strip().casefold().replace("-", " ").split()) for n, more in VOCABULARY.items() for a in [n, *more]})
_KNOWN = "regexp_replace(trim(replace(lower(trim({x})), '-', ' ')), '\\s+', '_', 'g') IN (" + ", ".join(f"'{n}'" for n in _NAMES) + ")"


def problems_sql(v: str, shape: Shape, name: str, depth: int = 0) -> str:
    """SQL of a list of codes, from the same shape."""
    m, found, parts = f"m{depth}", [], []
    found.append((f"len(list_filter(json_keys({v}), lambda x: x NOT IN ({', '.join(repr(k) for k in shape.fields)}))) > 0", f"{name}:unknown"))
    for key, f in shape.fields.items():
        part, path = f"json_extract({v}, '$.{key}')", f"{name}.{key}"
        right, plain = _is_sql(part, f.kind), f"({v} ->> '$.{key}')"
        among = lambda x, f=f: f"{x} IN ({', '.join(repr(y) for y in f.values)})"
        if f.required:
            found.append((f"{part} IS NULL", f"{path}:missing"))
        found.append((f"{part} IS NOT NULL AND NOT {right}", f"{path}:kind"))
        if f.kind == "string" and f.values:
            found.append((f"{right} AND NOT {among(plain)}", f"{path}:value"))
        if f.check:
            found.append((f"{right} AND NOT {_KNOWN.format(x=plain)}", f"{path}:value"))
        if f.low is not None:
            found.append((f"{right} AND TRY_CAST({plain} AS DOUBLE) NOT BETWEEN {f.low} AND {f.high}", f"{path}:range"))
        if f.kind == "object" and f.shape:
            parts.append(f"CASE WHEN {right} THEN {problems_sql(part, f.shape, path, depth)} ELSE [] END")
        if f.kind == "list":
            members = f"CASE WHEN {right} THEN json_extract({v}, '$.{key}[*]') ELSE [] END"
            if f.shape:
                parts.append(f"flatten(list_transform({members}, lambda {m}: CASE WHEN {_is_sql(m, 'object')} THEN {problems_sql(m, f.shape, path + '[]', depth + 1)} ELSE ['{path}[]:kind'] END))")
            elif f.members:
                found.append((f"len(list_filter({members}, lambda {m}: NOT {_is_sql(m, f.members)})) > 0", f"{path}[]:kind"))
                if f.values:
                    text = f"({m} ->> '$')"
                    found.append((f"len(list_filter({members}, lambda {m}: {_is_sql(m, f.members)} AND NOT {among(text)})) > 0", f"{path}[]:value"))
    for a, b in shape.ordered:
        x, y = (f"json_extract({v}, '$.{c}')" for c in (a, b))
        found.append((f"{_is_sql(x, 'number')} AND {_is_sql(y, 'number')} AND CAST({y} AS DOUBLE) < CAST({x} AS DOUBLE)", f"{name}:order"))
    if shape.any_of:
        empty = " AND ".join(f"coalesce(json_extract({v}, '$.{k}')::VARCHAR, 'null') IN ('null', '[]', '\"\"')" for k in shape.any_of)
        found.append((empty, f"{name}:empty"))
    own = ", ".join(f"CASE WHEN {bad} THEN '{code}' END" for bad, code in found)
    return f"list_distinct(list_filter(flatten([[{own}], {', '.join(parts) or '[]'}]), lambda x: x IS NOT NULL))"


DOCUMENTS = f"{TL}, en AS (SELECT * REPLACE (coalesce(k, 0) AS k) FROM tl), docs AS (SELECT entity_id, event_id, idx, {_document('VARCHAR')}::JSON AS document FROM en)"


def documents_of(spark, sf_dir):
    return beats_of(spark, sf_dir).select(E, "event_id", "idx", F.expr(_document("STRING")).alias("document"))


@query("event_contract", f"WITH {DOCUMENTS} SELECT event_id, unnest({problems_sql('document', EVENT, 'event')}) AS violation FROM docs")
def event_contract(spark, sf_dir):
    return contracts.check_documents(documents_of(spark, sf_dir), EVENT, "event", "event_id")


_PAYLOAD = """concat('{{"schema_version": ', CASE entity_id % 3 WHEN 0 THEN '"1.0"' WHEN 1 THEN '"2.0"' ELSE '1' END, ', "song_name": "s', CAST(entity_id AS {text}), '", "generated_from": ', CASE WHEN entity_id % 2 = 0 THEN '{{}}' ELSE '[]' END, CASE WHEN entity_id % 5 = 0 THEN '' ELSE concat(', "events": [', {events}, ']') END, '}}')"""


@query("payload_contract", f"WITH {DOCUMENTS}, p AS (SELECT entity_id, {_PAYLOAD.format(text='VARCHAR', events='''string_agg(document::VARCHAR, ', ' ORDER BY idx)''')}::JSON AS document FROM docs GROUP BY entity_id) SELECT entity_id, unnest({problems_sql('document', PAYLOAD, 'payload')}) AS violation FROM p")
def payload_contract(spark, sf_dir):
    docs = documents_of(spark, sf_dir).groupBy(E).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "document"))), lambda x: x["document"]).alias("_d"))
    payloads = docs.select(E, F.expr(_PAYLOAD.format(text="STRING", events="array_join(_d, ', ')")).alias("document"))
    return contracts.check_documents(payloads, PAYLOAD, "payload", E)


@query("windows_outside", f"WITH {TL}, du AS (SELECT entity_id, max(t) - 3600000000 * (entity_id % 3) AS duration FROM tl GROUP BY entity_id) SELECT event_id FROM tl JOIN du USING (entity_id) WHERE coalesce(next_t, t) > duration + 1e-6 OR t < 0")
def windows_outside(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    durations = rows.groupBy(E).agg((F.max("t") - 3_600_000_000 * (F.col(E) % 3)).alias("duration"))
    return contracts.outside(rows, durations, "event_id")
