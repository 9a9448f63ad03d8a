"""Queries of the layers' validators, over chords, hits, patterns and callbacks made from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layer_checks
from .feature_queries import beats_of
from .registry import HOUR, TL, query
from .timeline_queries import E

DAY = 24 * HOUR
EN = f"{TL}, en AS (SELECT * REPLACE (coalesce(k, 0) AS k), coalesce(next_t, t) AS end_t FROM tl)"


@query(
    "chord_report",
    f"""WITH {EN}, rf AS (SELECT entity_id, idx, t, ['C', 'Am', 'F'][(bar // 3 + entity_id) % 3 + 1] AS label FROM en),
ch AS (SELECT *, sum(CASE WHEN label IS DISTINCT FROM before_ THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY idx) AS run FROM (SELECT *, lag(label) OVER (PARTITION BY entity_id ORDER BY idx) AS before_ FROM rf)),
rn AS (SELECT entity_id, run, any_value(label) AS label, min(t) AS s, coalesce(lead(min(t)) OVER (PARTITION BY entity_id ORDER BY run), max(max(t)) OVER (PARTITION BY entity_id)) AS e FROM ch GROUP BY entity_id, run),
c AS (SELECT entity_id, event_id, t AS start_t, t + (k % 7 + 1) * {12 * HOUR} AS end_t, CASE WHEN k % 17 = 0 THEN 'G' ELSE ['C', 'Am', 'F'][(bar // 3 + entity_id) % 3 + 1] END AS label FROM en WHERE idx % 4 = 1),
p AS (SELECT c.*, rn.label AS other, least(end_t, e) - greatest(start_t, s) AS shared, row_number() OVER (PARTITION BY event_id ORDER BY least(end_t, e) - greatest(start_t, s) DESC, s) AS r FROM c JOIN rn ON rn.entity_id = c.entity_id AND s < end_t AND e > start_t),
d AS (SELECT c.entity_id, c.event_id, round(coalesce(shared / (c.end_t - c.start_t), 0), 6) AS ratio, CASE WHEN shared IS NULL THEN 'none' WHEN shared / (c.end_t - c.start_t) < 0.5::DOUBLE THEN 'short' WHEN other <> c.label THEN 'label' ELSE 'ok' END AS result FROM c LEFT JOIN p ON p.event_id = c.event_id AND r = 1)
SELECT entity_id, count_if(result = 'ok') AS matched, count_if(result <> 'ok') AS mismatched, count_if(result = 'short') AS timing_overlap_failures, count_if(result = 'label') AS label_mismatches, count_if(result = 'none') AS no_reference_overlaps, round(median(ratio), 6) AS median_overlap_ratio, count_if(result = 'ok') / count(*) AS match_ratio,
  CASE WHEN count_if(result = 'ok') / count(*) < 0.85::DOUBLE OR count_if(result = 'label') > 0 OR count_if(result = 'short') > 2 THEN 'failed' ELSE 'passed' END AS status FROM d GROUP BY 1""",
)
def chord_report(spark, sf_dir):
    rows, k = beats_of(spark, sf_dir), F.col("k")
    chord = F.element_at(F.array(F.lit("C"), F.lit("Am"), F.lit("F")), ((F.floor(F.col("bar") / 3) + F.col(E)) % 3 + 1).cast("int"))
    chords = rows.where("idx % 4 = 1").select(E, "event_id", F.col("t").alias("start_t"), (F.col("t") + (k % 7 + 1) * (12 * HOUR)).alias("end_t"), F.when(k % 17 == 0, "G").otherwise(chord).alias("label"))
    return layer_checks.chord_report(layer_checks.chord_results(chords, rows.select(E, "idx", "t", chord.alias("label")), 2 * DAY))


_KIND = "['kick', 'snare', 'hat', 'hat', 'unresolved'][k % 5 + 1]"
HITS = f"{EN}, hi AS (SELECT entity_id, event_id, idx AS place, t + CASE WHEN event_id % 97 = 0 THEN -{5 * DAY} ELSE 0 END AS t, CASE WHEN event_id % 211 = 0 THEN 'bell' ELSE {_KIND} END AS kind, k % 3 <> 0 AS resolved, CASE WHEN k % 3 <> 0 AND event_id % 307 <> 0 THEN beat_in_bar END AS aligned_beat FROM en)"


def hits_of(spark, sf_dir):
    rows, k, i = beats_of(spark, sf_dir), F.col("k"), F.col("event_id")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("kick", "snare", "hat", "hat", "unresolved")]), (k % 5 + 1).cast("int"))
    beat = F.when((k % 3 != 0) & (i % 307 != 0), F.col("beat_in_bar"))
    hits = rows.select(E, "event_id", F.col("idx").alias("place"), (F.col("t") + F.when(i % 97 == 0, -5 * DAY).otherwise(0)).alias("t"), F.when(i % 211 == 0, "bell").otherwise(kind).alias("kind"), (k % 3 != 0).alias("resolved"), beat.alias("aligned_beat"), F.col("bar").alias("aligned_bar"), F.col("idx").alias("aligned_idx"))
    return rows, hits


@query(
    "drum_diagnostics",
    f"""WITH {HITS}, bg AS (SELECT entity_id, t - lag(t) OVER (PARTITION BY entity_id ORDER BY t) AS g FROM en), iv AS (SELECT entity_id, median(g)::DOUBLE AS beat_interval FROM bg WHERE g > 0 GROUP BY 1),
hg AS (SELECT entity_id, t - lag(t) OVER (PARTITION BY entity_id ORDER BY t, event_id) AS g FROM hi WHERE kind = 'hat'), pu AS (SELECT entity_id, median(g)::DOUBLE AS hat_interval, count_if(g < beat_interval / 6) AS dense FROM hg LEFT JOIN iv USING (entity_id) WHERE g > 0 GROUP BY 1),
su AS (SELECT entity_id, count(*) AS event_count, {', '.join(f"count_if(kind = '{k}') AS {k}_count" for k in layer_checks.DRUM_KINDS)}, round(count_if(resolved) / count(*), 6) AS aligned_event_ratio, count_if(kind = 'snare' AND aligned_beat IN (2, 4)) >= 2 AND count_if(kind = 'kick' AND aligned_beat IN (1, 3)) >= 2 AS recognizable_backbeat FROM hi GROUP BY 1)
SELECT su.*, beat_interval, hat_interval, coalesce(dense, 0) AS overdense_hat_regions, coalesce(hat_interval >= beat_interval * 0.2::DOUBLE AND hat_interval <= beat_interval * 0.75::DOUBLE, false) AS recognizable_hat_pulse FROM su LEFT JOIN iv USING (entity_id) LEFT JOIN pu USING (entity_id)""",
)
def drum_diagnostics(spark, sf_dir):
    rows, hits = hits_of(spark, sf_dir)
    return layer_checks.drum_diagnostics(hits, rows)


@query(
    "drum_checks",
    f"""WITH {HITS}, l AS (SELECT *, coalesce(t < lag(t) OVER (PARTITION BY entity_id ORDER BY place), false) AS later FROM hi),
s AS (SELECT entity_id, count(DISTINCT event_id) = count(*) AS a, count_if(later) = 0 AS b, count_if(kind NOT IN ('kick', 'snare', 'hat', 'unresolved')) = 0 AS c, entity_id % 9 <> 0 AS d, count_if(resolved AND aligned_beat IS NULL) = 0 AS e FROM l GROUP BY 1)
SELECT entity_id, unnest(['drum_events_present', 'event_ids_unique', 'event_times_sorted', 'event_types_supported', 'summary_counts_match_event_rows', 'resolved_events_have_alignment_fields']) AS "check", unnest([true, a, b, c, d, e]) AS passed FROM s""",
)
def drum_checks(spark, sf_dir):
    _, hits = hits_of(spark, sf_dir)
    kinds = [F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in layer_checks.DRUM_KINDS]
    summary = hits.groupBy(E).agg((F.count("*") + F.when(F.col(E) % 9 == 0, 1).otherwise(0)).alias("event_count"), *kinds)
    return layer_checks.drum_checks(hits, summary)


@query(
    "pattern_checks",
    f"""WITH {EN}, oc AS (SELECT entity_id, k % 6 AS pattern, bar AS start_bar, bar + CASE WHEN event_id % 41 = 0 THEN 5 ELSE k % 6 END AS end_bar FROM en WHERE beat_in_bar = 1),
pa AS (SELECT entity_id, pattern, pattern + 1 AS bar_count, count(*) - CASE WHEN pattern = 5 AND entity_id % 4 = 0 THEN 1 ELSE 0 END AS occurrence_count FROM oc GROUP BY 1, 2), la AS (SELECT entity_id, max(bar) AS last FROM en GROUP BY 1),
ol AS (SELECT oc.*, bar_count, last, lag(end_bar) OVER (PARTITION BY oc.entity_id, oc.pattern ORDER BY start_bar) AS before_ FROM oc JOIN pa USING (entity_id, pattern) JOIN la USING (entity_id)),
fo AS (SELECT entity_id, pattern, count(*) AS n, count_if(end_bar - start_bar + 1 <> bar_count OR end_bar > last) AS odd, count_if(start_bar <= coalesce(before_, 0)) AS over_ FROM ol GROUP BY 1, 2), ea AS (SELECT * FROM pa JOIN fo USING (entity_id, pattern))
SELECT entity_id, pattern::VARCHAR || unnest(['_bar_count_range', '_occurrence_count_matches_rows', '_occurrence_lengths_match_bar_count', '_occurrences_non_overlapping']) AS "check", unnest([bar_count BETWEEN 2 AND 24, occurrence_count = n, odd = 0, over_ = 0]) AS passed FROM ea
UNION ALL SELECT entity_id, unnest(['pattern_count_matches_rows', 'pattern_ids_unique']), unnest([entity_id % 5 <> 0, true]) FROM pa GROUP BY entity_id""",
)
def pattern_checks(spark, sf_dir):
    rows, k = beats_of(spark, sf_dir), F.col("k")
    occurrences = rows.where("beat_in_bar = 1").select(E, (k % 6).alias("pattern"), F.col("bar").alias("start_bar"), (F.col("bar") + F.when(F.col("event_id") % 41 == 0, 5).otherwise(k % 6)).alias("end_bar"))
    patterns = occurrences.groupBy(E, "pattern").agg((F.count("*") - F.when((F.col("pattern") == 5) & (F.col(E) % 4 == 0), 1).otherwise(0)).alias("occurrence_count")).withColumn("bar_count", F.col("pattern") + 1)
    counts = patterns.groupBy(E).agg((F.count("*") + F.when(F.col(E) % 5 == 0, 1).otherwise(0)).alias("pattern_count"))
    return layer_checks.pattern_checks(patterns, occurrences, rows.select(E, "bar"), counts)


@query(
    "unified_report",
    f"""WITH {EN}, s AS (SELECT entity_id, count_if(label = 'click' AND event_id % 53 = 0) = 0 AS a, count_if(label = 'view' AND event_id % 61 = 0) = 0 AS b, count_if(label = 'purchase' AND k % 40 = 0) = 0 AS c, count_if(label = 'signup' AND event_id % 31 = 0) = 0 AS g, entity_id % 11 <> 0 AS h FROM en GROUP BY 1),
an AS (SELECT entity_id, count_if(t2 < before_) = 0 AS d FROM (SELECT *, lag(t2) OVER (PARTITION BY entity_id ORDER BY idx) AS before_ FROM (SELECT *, t - CASE WHEN event_id % 89 = 0 THEN {3 * DAY} ELSE 0 END AS t2 FROM en)) GROUP BY 1),
pk AS (SELECT entity_id, count_if(label = 'error' AND (k % 30) NOT IN (SELECT x.k % 30 FROM en x WHERE x.entity_id = en.entity_id AND x.label = 'purchase' AND x.k % 40 <> 0)) = 0 AS e FROM en GROUP BY 1),
r AS (SELECT entity_id, [a, b, c, d, e, true, true, true, g, h] AS v FROM s JOIN an USING (entity_id) JOIN pk USING (entity_id))
SELECT entity_id, len(list_filter(v, lambda x: x)) AS matched, 10 - len(list_filter(v, lambda x: x)) AS mismatched, len(list_filter(v, lambda x: x)) / 10 AS match_ratio, CASE WHEN len(list_filter(v, lambda x: x)) = 10 THEN 'passed' ELSE 'failed' END AS status FROM r""",
)
def unified_report(spark, sf_dir):
    rows, k, i = beats_of(spark, sf_dir), F.col("k"), F.col("event_id")
    entities = rows.select(E).distinct()
    listed = lambda label, bad=None: rows.where(F.col("label") == label).select(E, F.col("idx").alias("place"), (i if bad is None else F.when(bad, -i).otherwise(i)).alias("id"))
    patterns = rows.where("label = 'purchase' and k % 40 <> 0").select(E, (k % 30).alias("id")).distinct()
    layer = rows.where("label = 'purchase'").select(E, F.when(k % 40 == 0, -1).otherwise(k % 30).alias("id")).distinct()
    ids = lambda x: rows.select(E, x.alias("id")).distinct()
    recalls = rows.where("label = 'signup'").select(E, (k % 4).alias("motif_id"), (k % 6).alias("group_id"), F.when(i % 31 == 0, -1).when(k % 5 != 0, F.col("bar")).alias("section_id"))
    tables = {
        "phrases": listed("click", i % 53 == 0), "windows": listed("click"), "accents": listed("view", i % 61 == 0), "candidates": listed("view"), "layer_patterns": layer, "patterns": patterns,
        "anchors": rows.select(E, F.col("idx").alias("place"), (F.col("t") - F.when(i % 89 == 0, 3 * DAY).otherwise(0)).alias("t")), "callbacks": rows.where("label = 'error'").select(E, (k % 30).alias("pattern_id"), F.col("bar").alias("section_id")),
        "recalls": recalls, "motifs": ids(k % 4), "groups": ids(k % 6), "sections": ids(F.col("bar")), "durations": rows.groupBy(E).agg(F.max("end_t").alias("last_end"), (F.max("end_t") + F.when(F.col(E) % 11 == 0, 1).otherwise(0)).alias("duration")),
    }
    return layer_checks.check_report(layer_checks.unified_checks(entities, tables))
