"""Queries of the event rules, contracts, validators, and of the other proxy tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import canonical_label, clock, cosine, html_escape, keyword_labels, ladder, normal_chord, note_name, overlap, timing_direction
from ..operators import features, grid, joins, layers, rules, sequences, validation, windows
from ..sources import tables
from ..streaming import streams
from .registry import HOUR, SQL, TL, query
from .timeline_queries import E, SECTIONS, rows_of, sections_of

#: The feature row of the rules: change of energy, tension (k), and the end of the beat.
FEATURES = """f AS (SELECT *, coalesce(energy - before, 0) AS rise, coalesce(next_t, t) AS end_t FROM tl),
stats AS (SELECT entity_id, sum(energy)::BIGINT / count(*)::DOUBLE + 0.5 * CASE WHEN count(*) > 1 THEN sqrt((count(*) * sum(energy * energy)::BIGINT - sum(energy)::BIGINT * sum(energy)::BIGINT)::DOUBLE) / sqrt((count(*) * (count(*) - 1))::DOUBLE) ELSE 0.0 END AS loud,
  sum(rise)::BIGINT / count(*)::DOUBLE + 0.75 * CASE WHEN count(*) > 1 THEN sqrt((count(*) * sum(rise * rise)::BIGINT - sum(rise)::BIGINT * sum(rise)::BIGINT)::DOUBLE) / sqrt((count(*) * (count(*) - 1))::DOUBLE) ELSE 0.0 END AS jump FROM f GROUP BY 1),
x AS (SELECT f.*, loud, jump FROM f JOIN stats USING (entity_id))"""


def feature_rows(spark, sf_dir):
    rows = rows_of(spark, sf_dir).withColumns({"rise": windows.delta("energy"), "end_t": F.coalesce(F.lead("t").over(windows.order()), F.col("t"))})
    return rules.thresholds(rows, {"loud": ("energy", 0.5), "jump": ("rise", 0.75)})


def event_rules() -> list[rules.Rule]:
    e, rise, k = F.col("energy"), F.col("rise"), F.col("k")
    unit = lambda c: c.cast("double") / F.lit(50000.0)
    return [
        rules.Rule("build", (rise > 0) & (k >= 50) & (e >= 2000), unit(e), merge=True),
        rules.Rule("breakdown", (rise < 0) & (e < F.col("loud")), unit(-rise), merge=True),
        rules.Rule("drop", (rise >= F.col("jump")) & (e >= F.col("loud")), unit(rise)),
        rules.Rule("impact_hit", (F.col("label") == "purchase") & (e >= F.col("loud")), unit(e)),
        rules.Rule("pause_break", (F.col("end_t") - F.col("t") >= 24 * HOUR) & (e < F.col("loud")), unit(F.lit(25000) - e)),
        rules.Rule("tension_hold", (k >= 90) & (rise <= 0), unit(e)),
    ]


def _merged(kind: str, when: str, confidence: str) -> str:
    return f"""SELECT entity_id, '{kind}' AS type, min(t) AS start_t, max(end_t) AS end_t, min(idx) AS first_idx, max(idx) AS last_idx, max(greatest(0.0::DOUBLE, least(1.0::DOUBLE, {confidence}))) AS confidence
FROM (SELECT *, idx - row_number() OVER (PARTITION BY entity_id ORDER BY idx) AS g FROM x WHERE {when}) GROUP BY entity_id, g"""


def _single(kind: str, when: str, confidence: str) -> str:
    return f"SELECT entity_id, '{kind}' AS type, t AS start_t, end_t, idx AS first_idx, idx AS last_idx, greatest(0.0::DOUBLE, least(1.0::DOUBLE, {confidence})) AS confidence FROM x WHERE {when}"


EVENTS = " UNION ALL ".join(
    [
        _merged("build", "rise > 0 AND k >= 50 AND energy >= 2000", "energy / 50000.0::DOUBLE"),
        _merged("breakdown", "rise < 0 AND energy < loud", "-rise / 50000.0::DOUBLE"),
        _single("drop", "rise >= jump AND energy >= loud", "rise / 50000.0::DOUBLE"),
        _single("impact_hit", "label = 'purchase' AND energy >= loud", "energy / 50000.0::DOUBLE"),
        _single("pause_break", f"end_t - t >= {24 * HOUR} AND energy < loud", "(25000 - energy) / 50000.0::DOUBLE"),
        _single("tension_hold", "k >= 90 AND rise <= 0", "energy / 50000.0::DOUBLE"),
    ]
)


@query("rule_events", f"WITH {TL}, {FEATURES} {EVENTS}")
def rule_events(spark, sf_dir):
    return rules.apply_rules(feature_rows(spark, sf_dir), event_rules())


@query(
    "fake_drops",
    f"""WITH {TL}, {FEATURES}, ev AS ({EVENTS}) SELECT p.entity_id, p.start_t, p.end_t FROM ev p WHERE p.type = 'pause_break'
AND NOT EXISTS (SELECT 1 FROM ev d WHERE d.type = 'drop' AND d.entity_id = p.entity_id AND d.start_t > p.end_t AND d.start_t <= p.end_t + {48 * HOUR})""",
)
def fake_drops(spark, sf_dir):
    events = rule_events_of(spark, sf_dir)
    return rules.without_following(events.where("type = 'pause_break'"), events.where("type = 'drop'"), 48 * HOUR).select(E, "start_t", "end_t")


def rule_events_of(spark, sf_dir):
    return rules.apply_rules(feature_rows(spark, sf_dir), event_rules())


@query(
    "section_states",
    f"""WITH {TL}, {FEATURES}, ev AS ({EVENTS}), s AS (SELECT entity_id, (idx - 1) // 16 AS section, min(idx) AS a, max(idx) AS b, max(energy) - min(energy) AS volatility, sum(energy)::BIGINT / count(*)::DOUBLE AS mean, max(loud) AS loud FROM x GROUP BY 1, 2)
SELECT s.entity_id, s.section, CASE WHEN NOT has_drop AND has_build AND mean < loud THEN 'no_drop_plateau' WHEN volatility < 10000 THEN 'groove_loop' WHEN NOT has_drop THEN 'tension_hold' ELSE 'open' END AS state
FROM (SELECT s.*, EXISTS (SELECT 1 FROM ev WHERE ev.entity_id = s.entity_id AND type = 'drop' AND first_idx BETWEEN a AND b) AS has_drop, EXISTS (SELECT 1 FROM ev WHERE ev.entity_id = s.entity_id AND type = 'build' AND first_idx BETWEEN a AND b) AS has_build FROM s) s""",
)
def section_states(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    events = rules.apply_rules(rows, event_rules()).withColumn("section", F.floor((F.col("first_idx") - 1) / 16))
    flags = events.groupBy(E, "section").agg(F.max(F.col("type") == "drop").alias("has_drop"), F.max(F.col("type") == "build").alias("has_build"))
    cards = rows.groupBy(E, F.floor((F.col("idx") - 1) / 16).alias("section")).agg((F.max("energy") - F.min("energy")).alias("volatility"), (F.sum("energy") / F.count("*")).alias("mean"), F.max("loud").alias("loud"))
    joined = cards.join(flags, [E, "section"], "left").fillna(False, ["has_drop", "has_build"])
    state = F.when(~F.col("has_drop") & F.col("has_build") & (F.col("mean") < F.col("loud")), "no_drop_plateau").when(F.col("volatility") < 10000, "groove_loop").when(~F.col("has_drop"), "tension_hold").otherwise("open")
    return joined.select(E, "section", state.alias("state"))


@query(
    "layer_changes",
    f"""WITH {TL}, m AS (SELECT *, coalesce(energy - before, 0) AS rise, max(energy) OVER w AS hi, min(energy) OVER w AS lo FROM tl WINDOW w AS (PARTITION BY entity_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING))
SELECT entity_id, event_id, CASE WHEN rise >= 3000 AND energy = hi THEN 'layer_add' ELSE 'layer_remove' END AS type FROM m WHERE (rise >= 3000 AND energy = hi) OR (rise <= -3000 AND energy = lo)""",
)
def layer_changes(spark, sf_dir):
    rows = rows_of(spark, sf_dir).withColumn("rise", windows.delta("energy"))
    return rules.layer_changes(rows, "energy", "rise", 3000).select(E, "event_id", "type")


@query(
    "variant_scores",
    f"""WITH {TL}, s AS (SELECT entity_id, event_id, least(1.0::DOUBLE, energy / 20000.0::DOUBLE) * 0.6 + k / 100.0::DOUBLE * 0.4 AS a, (1 - least(1.0::DOUBLE, energy / 20000.0::DOUBLE)) * 0.7 + k / 100.0::DOUBLE * 0.3 AS b, k / 100.0::DOUBLE AS c FROM tl),
r AS (SELECT *, list_reverse_sort([a, b, c]) AS v FROM s)
SELECT entity_id, event_id, v[1] AS top_score, CASE WHEN v[1] >= 0.62 AND v[1] - v[2] >= 0.05 THEN CASE WHEN a = v[1] THEN 'punch' WHEN b = v[1] THEN 'soft' ELSE 'rise' END END AS variant FROM r""",
)
def variant_scores(spark, sf_dir):
    loud = F.least(F.lit(1.0), F.col("energy") / F.lit(20000.0))
    k = F.col("k") / F.lit(100.0)
    picked = rules.pick_variant(rows_of(spark, sf_dir), {"punch": loud * 0.6 + k * 0.4, "soft": (1 - loud) * 0.7 + k * 0.3, "rise": k}, 0.62, 0.05)
    return picked.select(E, "event_id", "top_score", "variant")


#: Operations made up from the rows: a list of one to three for each third event.
OPS = f"""ops AS (SELECT event_id, s AS seq, ['confirm', 'retime', 'relabel', 'annotate', 'delete'][((event_id + s * 3) % 5 + 1)::INT] AS action, t + s AS start_t, t + s + {HOUR} AS end_t, 'type_' || s AS type, 'note ' || s AS note
FROM tl, (SELECT unnest([1, 2, 3]) AS s) WHERE event_id % 3 = 0 AND s <= event_id % 4)"""


@query(
    "override_merge",
    f"""WITH {TL}, {OPS}, cut AS (SELECT event_id, min(CASE WHEN action = 'delete' THEN seq END) AS gone FROM ops GROUP BY 1),
m AS (SELECT event_id, max_by(start_t, seq) FILTER (action = 'retime') AS s, max_by(end_t, seq) FILTER (action = 'retime') AS e, max_by(type, seq) FILTER (action = 'relabel') AS ty, max_by(note, seq) FILTER (action = 'annotate') AS n, max_by(action, seq) AS a FROM ops JOIN cut USING (event_id) WHERE gone IS NULL GROUP BY 1)
SELECT tl.event_id, coalesce(s, t) AS start_t, coalesce(e, t + {2 * HOUR}) AS end_t, coalesce(ty, label) AS type, n AS note, coalesce(a, 'generated') AS status FROM tl LEFT JOIN m USING (event_id) LEFT JOIN cut USING (event_id) WHERE gone IS NULL""",
)
def override_merge(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    events = rows.select("event_id", F.col("t").alias("start_t"), (F.col("t") + 2 * HOUR).alias("end_t"), F.col("label").alias("type"))
    seq = F.col("seq")
    names = F.array(*[F.lit(x) for x in ("confirm", "retime", "relabel", "annotate", "delete")])
    made = rows.where("event_id % 3 = 0").withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).where(seq <= F.col("event_id") % 4)
    operations = made.select(
        "event_id", "seq", F.element_at(names, ((F.col("event_id") + seq * 3) % 5 + 1).cast("int")).alias("action"), (F.col("t") + seq).alias("start_t"), (F.col("t") + seq + HOUR).alias("end_t"), F.concat(F.lit("type_"), seq).alias("type"), F.concat(F.lit("note "), seq).alias("note")
    )
    return rules.apply_overrides(events, operations)


@query("review_bands", f"WITH {TL}, c AS (SELECT event_id, least(1.0::DOUBLE, energy / 20000.0::DOUBLE) AS confidence, k FROM tl) SELECT event_id, confidence, CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.55 THEN 'medium' ELSE 'low' END AS band, abs(confidence - k / 100.0::DOUBLE) < 0.12 AS ambiguous FROM c")
def review_bands(spark, sf_dir):
    rows = rows_of(spark, sf_dir).withColumn("confidence", F.least(F.lit(1.0), F.col("energy") / F.lit(20000.0)))
    return rows.select("event_id", "confidence", rules.review_band(F.col("confidence")).alias("band"), (F.abs(F.col("confidence") - F.col("k") / F.lit(100.0)) < 0.12).alias("ambiguous"))


@query(
    "contract_violations",
    f"""WITH {TL}, made AS (SELECT event_id, CASE WHEN k % 7 = 0 THEN 'Build-Up ' WHEN k % 7 = 1 THEN ' pause' WHEN k % 7 = 2 THEN label ELSE 'drop' END AS type, t AS start_t, CASE WHEN k % 11 = 0 THEN t - 1 ELSE t END AS end_t, energy / 20000.0::DOUBLE AS confidence, CASE WHEN k % 5 = 0 THEN NULL ELSE k / 80.0::DOUBLE END AS intensity FROM tl)
SELECT event_id, 'type' AS violation FROM made WHERE type = 'Build-Up ' OR lower(type) IN ('click', 'view', 'purchase', 'signup', 'login', 'logout', 'search', 'refund', 'error')
UNION ALL SELECT event_id, 'time_order' FROM made WHERE end_t < start_t UNION ALL SELECT event_id, 'confidence' FROM made WHERE NOT confidence BETWEEN 0 AND 1 UNION ALL SELECT event_id, 'intensity' FROM made WHERE NOT (intensity IS NULL OR intensity BETWEEN 0 AND 1)""",
)
def contract_violations(spark, sf_dir):
    k = F.col("k")
    made = rows_of(spark, sf_dir).select(
        "event_id",
        F.when(k % 7 == 0, "Build-Up ").when(k % 7 == 1, " pause").when(k % 7 == 2, F.col("label")).otherwise("drop").alias("type"),
        F.col("t").alias("start_t"),
        F.when(k % 11 == 0, F.col("t") - 1).otherwise(F.col("t")).alias("end_t"),
        (F.col("energy") / F.lit(20000.0)).alias("confidence"),
        F.when(k % 5 != 0, k / F.lit(80.0)).alias("intensity"),
    )
    return validation.violations(made, validation.event_rules())


@query(
    "json_key_check",
    """SELECT event_id, list_aggregate(list_sort(list_filter(json_keys(props), lambda x: x <> 'j')), 'string_agg', ',') AS unknown, CASE WHEN list_contains(json_keys(props), 'j') THEN '' ELSE 'j' END || CASE WHEN list_contains(json_keys(props), 'k') THEN '' ELSE ',k' END AS missing FROM events""",
)
def json_key_check(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", F.array_join(validation.unknown_keys(F.col("props"), ["j"]), ",").alias("unknown"), F.array_join(validation.missing_keys(F.col("props"), ["j", "k"]), ",").alias("missing"))


CLICKS = f"""p AS (SELECT * FROM tl WHERE label = 'purchase'), g AS (SELECT entity_id, t AS gt FROM tl WHERE label = 'click'),
near AS (SELECT entity_id, event_id, delta FROM (SELECT p.entity_id, p.event_id, p.t - gt AS delta, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(p.t - gt), gt) AS r FROM p LEFT JOIN g ON p.entity_id = g.entity_id) WHERE r = 1)"""


@query(
    "validate_beats",
    f"""WITH {TL}, {CLICKS}, c AS (SELECT entity_id, coalesce(abs(delta) <= {6 * HOUR}, false) AS ok FROM near),
n AS (SELECT entity_id, count_if(ok)::BIGINT AS matched, count_if(NOT ok)::BIGINT AS mismatched FROM c GROUP BY 1)
SELECT entity_id, 'beats' AS target, matched, mismatched, matched / (matched + mismatched)::DOUBLE AS ratio, CASE WHEN matched / (matched + mismatched)::DOUBLE >= 0.8 THEN 'passed' ELSE 'failed' END AS status FROM n""",
)
def validate_beats(spark, sf_dir):
    points, clicks = rows_of(spark, sf_dir, "purchase").select(E, "event_id", "t"), rows_of(spark, sf_dir, "click").select(E, "t")
    near = joins.nearest(points, clicks, time="t")
    return validation.report(near.select(E, F.coalesce(F.abs("delta") <= 6 * HOUR, F.lit(False)).alias("ok")), "beats", 0.8)


@query(
    "timing_diagnosis",
    f"""WITH {TL}, {CLICKS} SELECT entity_id, sum(delta)::BIGINT / count(delta)::DOUBLE AS mean_error, sum(abs(delta))::BIGINT / count(delta)::DOUBLE AS mean_absolute, median(delta)::DOUBLE AS median_error, count_if(delta < 0)::BIGINT AS early, count_if(delta > 0)::BIGINT AS late FROM near WHERE delta IS NOT NULL GROUP BY 1""",
)
def timing_diagnosis(spark, sf_dir):
    points, clicks = rows_of(spark, sf_dir, "purchase").select(E, "event_id", "t"), rows_of(spark, sf_dir, "click").select(E, "t")
    return validation.timing_diagnosis(joins.nearest(points, clicks).where("delta is not null"))


@query(
    "validate_layers",
    f"""WITH {TL}, {SECTIONS}, o AS (SELECT entity_id, coalesce(start_t >= max(end_t) OVER (PARTITION BY entity_id ORDER BY start_t, end_t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS ok FROM sections),
q AS (SELECT tl.entity_id, r.entity_id IS NOT NULL AS ok FROM tl LEFT JOIN (SELECT DISTINCT entity_id, k FROM tl WHERE label = 'signup') r ON tl.entity_id = r.entity_id AND tl.k = r.k WHERE label = 'purchase'),
u AS (SELECT entity_id, 'order' AS target, true AS ok FROM tl UNION ALL SELECT entity_id, 'overlap', ok FROM o UNION ALL SELECT entity_id, 'references', ok FROM q),
n AS (SELECT entity_id, target, count_if(ok)::BIGINT AS matched, count_if(NOT ok)::BIGINT AS mismatched FROM u GROUP BY 1, 2)
SELECT entity_id, target, matched, mismatched, matched / (matched + mismatched)::DOUBLE AS ratio, CASE WHEN mismatched = 0 THEN 'passed' ELSE 'failed' END AS status FROM n""",
)
def validate_layers(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    ordered = validation.report(validation.ordered_check(rows, "idx"), "order")
    disjoint = validation.report(validation.disjoint_check(sections_of(rows)), "overlap")
    known = validation.report(validation.reference_check(rows.where("label = 'purchase'"), "k", rows.where("label = 'signup'"), "k"), "references")
    return ordered.unionByName(disjoint).unionByName(known)


@query("batch_exit_code", "SELECT CASE WHEN max(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) = 2 THEN 3 ELSE max(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) END::BIGINT AS exit_code, count_if(o_orderstatus = 'F')::BIGINT AS passed, count_if(o_orderstatus <> 'F')::BIGINT AS failed FROM orders")
def batch_exit_code(spark, sf_dir):
    codes = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("code"))
    return validation.exit_code(codes)


@query(
    "hint_alignment",
    f"""WITH {TL}, h AS (SELECT entity_id, event_id AS a_id, t AS a_start, t + {24 * HOUR} AS a_end FROM tl WHERE label = 'signup'), b AS (SELECT entity_id, event_id AS b_id, label AS b_label, t AS b_start, t + {6 * HOUR} AS b_end FROM tl WHERE label <> 'signup'),
p AS (SELECT *, least(a_end, b_end) - greatest(a_start, b_start) AS shared FROM h JOIN b USING (entity_id) WHERE least(a_end, b_end) > greatest(a_start, b_start)),
r AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY shared DESC, b_start, b_id) AS r, row_number() OVER (PARTITION BY a_id ORDER BY b_start, b_id) AS o FROM p)
SELECT entity_id, a_id, count(*) AS n, max(CASE WHEN r = 1 THEN b_id END) AS primary_id, string_agg(b_id::VARCHAR, ',' ORDER BY o) FILTER (o <= 12) AS first_ids FROM r GROUP BY 1, 2""",
)
def hint_alignment(spark, sf_dir):
    hints = rows_of(spark, sf_dir, "signup").select(E, F.col("event_id").alias("a_id"), F.col("t").alias("a_start"), (F.col("t") + 24 * HOUR).alias("a_end"))
    others = rows_of(spark, sf_dir).where("label <> 'signup'").select(E, F.col("event_id").alias("b_id"), F.col("t").alias("b_start"), (F.col("t") + 6 * HOUR).alias("b_end"))
    pairs = joins.overlapping(hints, others, 24 * HOUR)
    place = F.row_number().over(Window.partitionBy(E, "a_id").orderBy("b_start", "b_id"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_place") <= 12, F.struct("b_start", "b_id"))))  # no list is longer
    return pairs.withColumn("_place", place).groupBy(E, "a_id").agg(
        F.count("*").alias("n"),
        F.max_by("b_id", F.struct("shared", -F.col("b_start"), -F.col("b_id"))).alias("primary_id"),
        F.array_join(F.transform(listed, lambda x: x.b_id.cast("string")), ",").alias("first_ids"),
    )


@query(
    "event_union_dedup",
    f"""WITH {TL}, u AS (SELECT 0 AS r, event_id, entity_id, t, label AS type FROM tl WHERE energy >= 6000 UNION ALL SELECT 1, event_id, entity_id, t // {24 * HOUR} * {24 * HOUR}, 'view' FROM tl WHERE label = 'view'),
n AS (SELECT *, row_number() OVER (PARTITION BY entity_id, t // {24 * HOUR}, type ORDER BY r, event_id) AS n FROM u) SELECT entity_id, event_id, t, type FROM n WHERE n = 1""",
)
def event_union_dedup(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    first = rows.where("energy >= 6000").select(E, "event_id", "t", F.col("label").alias("type"))
    second = rows.where("label = 'view'").select(E, "event_id", (F.floor(F.col("t") / (24 * HOUR)) * (24 * HOUR)).alias("t"), F.lit("view").alias("type"))
    with_day = [df.withColumn("day", F.floor(F.col("t") / (24 * HOUR))) for df in (first, second)]
    return layers.refined_union(with_day, [E, "day", "type"]).select(E, "event_id", "t", "type")


@query("energy_ladder", f"WITH {TL} SELECT event_id, CASE WHEN energy >= 10000 THEN 'dense' WHEN energy >= 3000 THEN 'medium' ELSE 'sparse' END AS density FROM tl")
def energy_ladder(spark, sf_dir):
    return rows_of(spark, sf_dir).select("event_id", ladder(F.col("energy"), [(10000, "dense"), (3000, "medium")], "sparse").alias("density"))


@query(
    "scalar_texts",
    """WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events)
SELECT event_id, ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][(k % 12 + 1)::INT] || (k // 12 - 1)::VARCHAR AS note, (k // 60)::VARCHAR || ':' || lpad((k % 60)::VARCHAR, 2, '0') || '.0' AS clock_text,
replace(event_type || ' <a>&', '&', '&amp;').replace('<', '&lt;').replace('>', '&gt;') AS escaped, 'my_' || event_type AS canonical, CASE WHEN k - 50 BETWEEN -10 AND 10 THEN 'aligned' WHEN k < 50 THEN 'early' ELSE 'late' END AS direction,
CASE k % 4 WHEN 0 THEN 'Am' WHEN 1 THEN 'F#' WHEN 2 THEN 'Bbm' ELSE 'N' END AS chord FROM e""",
)
def scalar_texts(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", F.from_json("props", "k int")["k"])
    k = F.col("k")
    chord = F.when(k % 4 == 0, "Amin7").when(k % 4 == 1, "f#maj7").when(k % 4 == 2, "Bbm/F").otherwise("none")
    return events.select(
        "event_id", note_name(k).alias("note"), clock(k.cast("double")).alias("clock_text"), html_escape(F.concat("event_type", F.lit(" <a>&"))).alias("escaped"), canonical_label(F.concat(F.lit("  My-"), "event_type", F.lit(" "))).alias("canonical"),
        timing_direction(k - 50, 10).alias("direction"), normal_chord(chord).alias("chord"),
    )


KEYWORDS = [("network", ["http", "@"]), ("license", ["license", "licensed"]), ("shout", ["!!"])]


@query("keyword_labels", "SELECT doc_id, concat_ws(',', CASE WHEN contains(lower(text), 'http') OR contains(lower(text), '@') THEN 'network' END, CASE WHEN contains(lower(text), 'license') OR contains(lower(text), 'licensed') THEN 'license' END, CASE WHEN contains(text, '!!') THEN 'shout' END) AS labels FROM documents")
def keyword_label_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.array_join(keyword_labels(F.col("text"), KEYWORDS), ",").alias("labels"))


@query("lyric_lines", "SELECT conv_id, role AS line_role, min(turn)::BIGINT AS start_t, max(turn)::BIGINT + 1 AS end_t, count(*) AS n, string_agg(text, ' ' ORDER BY turn) AS line_text FROM conversations GROUP BY 1, 2")
def lyric_lines(spark, sf_dir):
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    tokens = talks.select("conv_id", F.col("role").alias("line_role"), F.lit("1").alias("line"), F.col("turn").alias("start_t"), (F.col("turn") + 1).alias("end_t"), "text")
    out = features.lines(tokens.withColumn("pair", F.struct("conv_id", "line_role")), "line", "text", by="pair")
    return out.select("pair.conv_id", "pair.line_role", "start_t", "end_t", "n", "line_text")


@query(
    "label_metrics",
    """WITH c AS (SELECT count_if(toxic = 1 AND quality = 1)::BIGINT AS tp, count_if(toxic <> 1 AND quality = 1)::BIGINT AS fp, count_if(toxic = 1 AND quality <> 1)::BIGINT AS fn FROM labels)
SELECT tp, fp, fn, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS "precision", coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall, coalesce(tp * 2.0::DOUBLE / nullif(tp * 2 + fp + fn, 0), 0) AS f1 FROM c""",
)
def label_metrics(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return features.precision_recall(labels, F.col("toxic") == 1, F.col("quality") == 1)


@query("split_songs", "WITH n AS (SELECT DISTINCT user_id AS entity_id FROM events), c AS (SELECT *, row_number() OVER (ORDER BY entity_id DESC) AS r, count(*) OVER () AS n FROM n) SELECT entity_id, CASE WHEN r <= greatest(1, least(ceil(n * 0.2::DOUBLE), n - 1)) THEN 'validation' ELSE 'train' END AS split FROM c")
def split_songs(spark, sf_dir):
    names = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias(E)).distinct()
    return features.validation_split(names)


@query("sampling_weights", "SELECT event_type, greatest(1.0::DOUBLE, least(8.0::DOUBLE, (sum(count(*)) OVER ()::BIGINT - count(*)) / count(*)::DOUBLE)) AS weight FROM events GROUP BY 1")
def sampling_weights(spark, sf_dir):
    counts = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    return counts.join(F.broadcast(total)).select("event_type", F.greatest(F.lit(1.0), F.least(F.lit(8.0), (F.col("all") - F.col("n")) / F.col("n"))).alias("weight"))


#: A left fold, so that sums are added up in the order of the list.
_ADDED = "list_reduce({}, lambda s, x: s + x)"


@query("band_sums", "SELECT vec_id, unnest([0, 1, 2, 3, 4, 5, 6]) AS band, unnest([" + ", ".join(_ADDED.format(f"list_transform(embedding[{a + 1}:{b}], lambda x: x::DOUBLE)") for a, b in zip([0, 9, 18, 27, 36, 45, 54], [9, 18, 27, 36, 45, 54, 64])) + "]) AS total FROM embeddings")
def band_sums(spark, sf_dir):
    """Sums of seven ranges of components."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return features.band_sums(vectors, "embedding", [0, 9, 18, 27, 36, 45, 54, 64]).select("vec_id", F.posexplode("bands").alias("band", "total"))


def _dot(a: str, b: str) -> str:
    return _ADDED.format(f"list_transform(list_zip({a}, {b}), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)")


@query("cosine_to_first", f"WITH f AS (SELECT arg_min(embedding, vec_id) AS first FROM embeddings), d AS (SELECT vec_id, {_dot('embedding', 'first')} AS d, sqrt({_dot('embedding', 'embedding')}) * sqrt({_dot('first', 'first')}) AS n FROM embeddings, f) SELECT vec_id, CASE WHEN n = 0 THEN 0 ELSE d / n END AS cosine FROM d")
def cosine_to_first(spark, sf_dir):
    """Cosine of every vector with that of the least id."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    first = vectors.agg(F.min_by("embedding", "vec_id").alias("_first"))
    return vectors.join(F.broadcast(first)).select("vec_id", cosine(F.col("embedding"), F.col("_first")).alias("cosine"))


@query(
    "closest_in_group",
    """WITH p AS (SELECT a.label, a.vec_id, b.vec_id AS other, list_reduce(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)), lambda x, y: x + y) AS score FROM embeddings a JOIN embeddings b ON a.label IS NOT DISTINCT FROM b.label AND a.vec_id <> b.vec_id)
SELECT label, vec_id, other, score FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, other) = 1""",
)
def closest_in_group(spark, sf_dir):
    """The most similar other vector of the same label."""
    return features.closest_in_group(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "label", "vec_id", "embedding")


@query("bar_steps", f"WITH {TL} SELECT entity_id, bar, min(t) AS start_t FROM tl WHERE (bar - 1) % 4 = 0 GROUP BY 1, 2")
def bar_steps(spark, sf_dir):
    return grid.every_bar(rows_of(spark, sf_dir).groupBy(E, "bar").agg(F.min("t").alias("start_t")), 4)


@query("preserved_sections", f"WITH {TL}, {SECTIONS} SELECT entity_id, section FROM sections s WHERE NOT EXISTS (SELECT 1 FROM tl WHERE tl.entity_id = s.entity_id AND label = 'purchase' AND t >= s.start_t AND t < s.end_t)")
def preserved_sections(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    sections = sections_of(rows)
    hit = joins.containing(rows.where("label = 'purchase'").select(E, "event_id", "t"), sections).select(E, F.col("inside.section").alias("section"))
    return sections.join(hit.where("section is not null").distinct(), [E, "section"], "left_anti").select(E, "section")


@query("artifact_manifest", f"WITH {TL} SELECT entity_id, 'events' AS artifact, count(*) AS rows FROM tl GROUP BY 1 UNION ALL SELECT entity_id, 'sections', count(DISTINCT (idx - 1) // 8) FROM tl GROUP BY 1")
def artifact_manifest(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    return tables.manifest({"events": rows, "sections": sections_of(rows)})


@query("timeline_markdown", f"WITH {TL} SELECT entity_id, '| event_id | label |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || event_id || ' | ' || label || ' |', chr(10) ORDER BY idx) AS markdown FROM tl GROUP BY 1")
def timeline_markdown(spark, sf_dir):
    return tables.markdown_lines(rows_of(spark, sf_dir), ["event_id", "label"], ["idx"])


@query("duration_overlap", f"WITH {TL}, b AS (SELECT entity_id, bar, min(t) AS s, max(t) AS e FROM tl GROUP BY 1, 2), n AS (SELECT *, lead(s) OVER w AS ns, lead(e) OVER w AS ne FROM b WINDOW w AS (PARTITION BY entity_id ORDER BY bar)) SELECT entity_id, bar, greatest(0, least(e, ne) - greatest(s, ns)) AS shared FROM n WHERE ns IS NOT NULL")
def duration_overlap(spark, sf_dir):
    bars = rows_of(spark, sf_dir).groupBy(E, "bar").agg(F.min("t").alias("s"), F.max("t").alias("e"))
    w = windows.order("bar")
    pairs = bars.withColumns({"ns": F.lead("s").over(w), "ne": F.lead("e").over(w)}).where("ns is not null")
    return pairs.select(E, "bar", overlap(F.col("s"), F.col("e"), F.col("ns"), F.col("ne")).alias("shared"))


# The streaming forms: what a stream over the events file emits with its watermark passed is held
# against the batch result; append mode leaves the windows that are still open, so the queries use
# update-complete output where the result is to be whole.
def _stream(spark, sf_dir):
    return streams.event_stream(spark, f"{sf_dir}/events.parquet")


def _closed(width: int) -> str:
    return f"(SELECT max(epoch_us(ts)) - {HOUR} FROM events) >= epoch_us(start_ts) + {width}"


@query("stream_tumbling", f"WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS start_ts, event_type, count(*) AS n, max(value) AS max_value FROM events GROUP BY 1, 2) SELECT epoch_us(start_ts) AS start_us, event_type, n, max_value FROM w WHERE {_closed(24 * HOUR)}")
def stream_tumbling(spark, sf_dir):
    return streams.run(streams.tumbling(_stream(spark, sf_dir), "1 day", "1 hour")).select(F.unix_micros("start_ts").alias("start_us"), "event_type", "n", "max_value")


@query("stream_distinct", "SELECT DISTINCT event_id, user_id FROM events")
def stream_distinct(spark, sf_dir):
    return streams.run(streams.distinct_events(_stream(spark, sf_dir), "1 hour")).select("event_id", "user_id")


@query("stream_cooldown", f"SELECT * FROM ({SQL['cooldown_accents'].replace('energy >= 3000', 'true')}) WHERE (t + 999) // 1000 < (SELECT max(epoch_ms(ts)) - {HOUR // 1000} FROM events)")
def stream_cooldown(spark, sf_dir):
    """Events behind the last watermark are decided; those within the hour before the last event still wait."""
    kept = streams.run(streams.cooldown(_stream(spark, sf_dir), 24 * 3600.0))
    return kept.select(F.col("user_id").alias(E), "event_id", F.unix_micros("ts").alias("t"))


@query("stream_sliding", f"""WITH w AS (SELECT time_bucket(INTERVAL 6 HOURS, ts) - i * INTERVAL 6 HOURS AS start_ts, event_type, count(*) AS n FROM events, range(4) AS r(i) GROUP BY 1, 2) SELECT epoch_us(start_ts) AS start_us, event_type, n FROM w WHERE {_closed(24 * HOUR)}""")
def stream_sliding(spark, sf_dir):
    return streams.run(streams.sliding(_stream(spark, sf_dir), "24 hours", "6 hours", "1 hour")).select(F.unix_micros("start_ts").alias("start_us"), "event_type", "n")


@query("stream_sessions", f"""WITH o AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) <= {12 * HOUR} THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM o), g AS (SELECT user_id, min(epoch_us(ts)) AS start_us, max(epoch_us(ts)) + {12 * HOUR} AS end_us, count(*) AS n FROM s GROUP BY user_id, s) SELECT * FROM g WHERE end_us <= (SELECT max(epoch_us(ts)) - {HOUR} FROM events)""")
def stream_sessions(spark, sf_dir):
    out = streams.run(streams.sessions(_stream(spark, sf_dir), "12 hours", "1 hour"))
    return out.select("user_id", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), "n")


@query("note_runs", f"WITH {TL}, m AS (SELECT *, CASE WHEN lag(k // 20) OVER (PARTITION BY entity_id ORDER BY idx) IS NOT DISTINCT FROM k // 20 THEN 0 ELSE 1 END AS new FROM tl), i AS (SELECT *, sum(new) OVER (PARTITION BY entity_id ORDER BY idx) - 1 AS run FROM m) SELECT entity_id, run::BIGINT AS run, min(k // 20) AS band, count(*) AS n_rows FROM i GROUP BY 1, 2")
def note_runs(spark, sf_dir):
    rows = rows_of(spark, sf_dir).withColumn("band", F.floor(F.col("k") / 20))
    return sequences.runs(rows, "band").select(E, "run", "band", "n_rows")
