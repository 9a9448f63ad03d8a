"""Validators of layers: chords, drums, patterns and the unified layer, each as named checks by entity, and their reports.

A check is a row (entity_id, check, passed), so all validators share one report. What a validator compares are tables; no entity is gathered.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins, sequences
from .windows import ENTITY, order

#: Least share of matching chords, and most label mismatches and short overlaps, that pass. Fixed values.
CHORD_RATIO, CHORD_MISMATCHES, CHORD_SHORT = 0.85, 0, 2
#: Kinds of drum events; most bars of a pattern. Fixed values.
DRUM_KINDS, PATTERN_BARS = ["kick", "snare", "hat", "unresolved"], 24
#: A hat pulse lies between these shares of the beat; hats closer than a sixth of it are too dense. Fixed values.
PULSE, DENSE = (0.2, 0.75), 6.0


def named_checks(by_entity: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """A row for each entity and check; a check without a value fails."""
    listed = F.array(*[F.struct(F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("passed")) for name, ok in checks.items()])
    return by_entity.select(ENTITY, F.explode(listed).alias("_c")).select(ENTITY, "_c.*")


def all_checks(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_report(checks: DataFrame) -> DataFrame:
    """(entity_id, matched, mismatched, match_ratio, status) of checks: passed if all are."""
    ok = F.count_if("passed")
    counted = checks.groupBy(ENTITY).agg(ok.alias("matched"), (F.count("*") - ok).alias("mismatched"))
    return counted.select(ENTITY, "matched", "mismatched", (F.col("matched") / (F.col("matched") + F.col("mismatched"))).alias("match_ratio"), F.when(F.col("mismatched") == 0, "passed").otherwise("failed").alias("status"))


def chord_results(chords: DataFrame, reference: DataFrame, width: int, least: float = 0.5) -> DataFrame:
    """chords (event_id, start_t, end_t, label) held against reference beats (idx, t, label): beats of one label in a row are one chord, which
    ends where the next begins, the last at the last beat. Rows: entity_id, event_id, overlap_ratio, result."""
    runs = sequences.runs(reference)
    a = chords.select(ENTITY, F.col("event_id").alias("a_id"), F.col("start_t").alias("a_start"), F.col("end_t").alias("a_end"), F.col("label").alias("a_label"))
    b = runs.select(ENTITY, F.col("run").alias("b_id"), F.col("start_t").alias("b_start"), F.col("end_t").alias("b_end"), F.col("label").alias("b_label"))
    names = F.create_map(*[F.lit(x) for pair in {"missing": "no_reference_overlap", "short": "timing_overlap_failure", "differs": "label_mismatch", "match": "matched"}.items() for x in pair])
    return joins.best_overlap(a, b, width, least).select(ENTITY, F.col("a_id").alias("event_id"), F.round("ratio", 6).alias("overlap_ratio"), F.element_at(names, F.col("result")).alias("result"))


def chord_report(results: DataFrame) -> DataFrame:
    """Counts by result, the median overlap and the status of each entity's chords."""
    count = lambda *names: F.count_if(F.col("result").isin(*names))
    found = results.groupBy(ENTITY).agg(
        count("matched").alias("matched"), (F.count("*") - count("matched")).alias("mismatched"), count("timing_overlap_failure").alias("timing_overlap_failures"), count("label_mismatch").alias("label_mismatches"), count("no_reference_overlap").alias("no_reference_overlaps"), F.round(F.median("overlap_ratio"), 6).alias("median_overlap_ratio")
    )
    ratio = F.col("matched") / (F.col("matched") + F.col("mismatched"))
    failed = (ratio < CHORD_RATIO) | (F.col("label_mismatches") > CHORD_MISMATCHES) | (F.col("timing_overlap_failures") > CHORD_SHORT)
    return found.withColumns({"match_ratio": ratio, "status": F.when(failed, "failed").otherwise("passed")})


def drum_diagnostics(hits: DataFrame, beats: DataFrame) -> DataFrame:
    """Diagnostics of an entity's hits (event_id, t, kind, aligned_beat, resolved) against the median time between its beats (t): counts by kind, share
    aligned, backbeat (two snares on even and two kicks on odd beats at least), hat pulse and regions of too dense hats."""
    c = F.col
    gap = c("t") - F.lag("t").over(Window.partitionBy(ENTITY).orderBy("t"))
    interval = beats.withColumn("_g", gap).where("_g > 0").groupBy(ENTITY).agg(F.median("_g").alias("beat_interval"))
    hats = hits.where("kind = 'hat'").withColumn("_g", c("t") - F.lag("t").over(Window.partitionBy(ENTITY).orderBy("t", "event_id"))).where("_g > 0").join(interval, ENTITY, "left")
    pulse = hats.groupBy(ENTITY).agg(F.median("_g").alias("hat_interval"), F.count_if(c("_g") < c("beat_interval") / DENSE).alias("overdense_hat_regions"))
    kinds = [F.count_if(c("kind") == k).alias(f"{k}_count") for k in DRUM_KINDS]
    on = lambda kind, beats_: F.count_if((c("kind") == kind) & c("aligned_beat").isin(*beats_))
    sums = hits.groupBy(ENTITY).agg(F.count("*").alias("event_count"), *kinds, F.round(F.count_if("resolved") / F.count("*"), 6).alias("aligned_event_ratio"), ((on("snare", (2, 4)) >= 2) & (on("kick", (1, 3)) >= 2)).alias("recognizable_backbeat"))
    joined = sums.join(interval, ENTITY, "left").join(pulse, ENTITY, "left").fillna(0, ["overdense_hat_regions"])
    return joined.withColumn("recognizable_hat_pulse", F.coalesce((c("hat_interval") >= c("beat_interval") * PULSE[0]) & (c("hat_interval") <= c("beat_interval") * PULSE[1]), F.lit(False)))


def drum_checks(hits: DataFrame, summary: DataFrame) -> DataFrame:
    """Checks of hits (place in their file, event_id, t, kind, resolved, aligned_bar, aligned_beat, aligned_idx) and their summary (event_count and a
    count for each kind)."""
    c = F.col
    later = F.coalesce(c("t") < F.lag("t").over(Window.partitionBy(ENTITY).orderBy("place")), F.lit(False))
    odd = c("resolved") & (c("aligned_bar").isNull() | c("aligned_beat").isNull() | c("aligned_idx").isNull())
    counts = {"event_count": F.count("*"), **{f"{k}_count": F.count_if(c("kind") == k) for k in DRUM_KINDS}}
    sums = hits.withColumn("_later", later).groupBy(ENTITY).agg(F.count_distinct("event_id").alias("_ids"), F.count_if("_later").alias("_unsorted"), F.count_if(~c("kind").isin(DRUM_KINDS)).alias("_odd"), F.count_if(odd).alias("_unaligned"), *[x.alias(f"_{n}") for n, x in counts.items()])
    both = summary.join(sums, ENTITY, "left").fillna(0, [f"_{n}" for n in counts])
    agrees = reduce(Column.__and__, [c(n) == c(f"_{n}") for n in counts])
    return named_checks(both, {"drum_events_present": c("_event_count") > 0, "event_ids_unique": F.coalesce(c("_ids"), F.lit(0)) == c("_event_count"), "event_times_sorted": F.coalesce(c("_unsorted"), F.lit(0)) == 0, "event_types_supported": F.coalesce(c("_odd"), F.lit(0)) == 0, "summary_counts_match_event_rows": agrees, "resolved_events_have_alignment_fields": F.coalesce(c("_unaligned"), F.lit(0)) == 0})


def pattern_checks(patterns: DataFrame, occurrences: DataFrame, bars: DataFrame, counts: DataFrame) -> DataFrame:
    """Checks of patterns (pattern, bar_count, occurrence_count) and their occurrences (pattern, start_bar, end_bar): the file's pattern_count (counts), unique ids, and for
    each pattern its length, its number of occurrences, that these have its length within the entity's bars (bar), and that none overlaps the one before."""
    c = F.col
    last = bars.groupBy(ENTITY).agg(F.max("bar").alias("_last"))
    before = F.lag("end_bar").over(Window.partitionBy(ENTITY, "pattern").orderBy("start_bar"))
    placed = occurrences.withColumn("_before", before).join(patterns.select(ENTITY, "pattern", "bar_count").dropDuplicates([ENTITY, "pattern"]), [ENTITY, "pattern"]).join(last, ENTITY, "left")
    shaped = (c("end_bar") - c("start_bar") + 1 == c("bar_count")) & (c("start_bar") >= 1) & (c("start_bar") <= c("end_bar")) & (c("end_bar") <= F.coalesce("_last", F.lit(0)))
    found = placed.groupBy(ENTITY, "pattern").agg(F.count("*").alias("_n"), F.count_if(~shaped).alias("_misshapen"), F.count_if(c("start_bar") <= F.coalesce("_before", F.lit(0))).alias("_overlapping"))
    each = patterns.join(found, [ENTITY, "pattern"], "left").fillna(0, ["_n", "_misshapen", "_overlapping"])
    name = lambda what: F.concat(c("pattern").cast("string"), F.lit(f"_{what}"))
    tests = {"bar_count_range": c("bar_count").between(2, PATTERN_BARS), "occurrence_count_matches_rows": c("occurrence_count") == c("_n"), "occurrence_lengths_match_bar_count": c("_misshapen") == 0, "occurrences_non_overlapping": c("_overlapping") == 0}
    single = each.select(ENTITY, F.explode(F.array(*[F.struct(name(n).alias("check"), F.coalesce(ok, F.lit(False)).alias("passed")) for n, ok in tests.items()])).alias("_c")).select(ENTITY, "_c.*")
    rows = patterns.groupBy(ENTITY).agg(F.count("*").alias("_rows"), F.count_distinct("pattern").alias("_ids"))
    whole = counts.join(rows, ENTITY, "left").fillna(0, ["_rows", "_ids"])
    return named_checks(whole, {"pattern_count_matches_rows": c("pattern_count") == c("_rows"), "pattern_ids_unique": c("_ids") == c("_rows")}).unionByName(single)


def same_order_check(entities: DataFrame, left: DataFrame, right: DataFrame, name: str, key: str = "id") -> DataFrame:
    """Whether two tables (place, id) list the same ids in the same order for an entity."""
    number = F.row_number().over(order("place"))
    a, b = (t.select(ENTITY, number.alias("_n"), F.col(key).alias(k)) for t, k in ((left, "_a"), (right, "_b")))
    differ = a.join(b, [ENTITY, "_n"], "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(ENTITY).distinct().withColumn("_bad", F.lit(True))
    return named_checks(entities.select(ENTITY).join(differ, ENTITY, "left"), {name: F.col("_bad").isNull()})


def same_set_check(entities: DataFrame, left: DataFrame, right: DataFrame, name: str, key: str = "id") -> DataFrame:
    """Whether two tables have the same ids for an entity."""
    sides = left.select(ENTITY, key, F.lit(1).alias("_side")).unionByName(right.select(ENTITY, key, F.lit(2).alias("_side")))
    lone = sides.groupBy(ENTITY, key).agg(F.count_distinct("_side").alias("_n")).where("_n < 2").select(ENTITY).distinct().withColumn("_bad", F.lit(True))
    return named_checks(entities.select(ENTITY).join(lone, ENTITY, "left"), {name: F.col("_bad").isNull()})


def references_check(entities: DataFrame, rows: DataFrame, column: str, known: DataFrame, known_key: str, name: str) -> DataFrame:
    """Whether every value of a column that is not null is known in its entity."""
    there = known.select(F.col(ENTITY).alias("_e"), F.col(known_key).alias("_k"))
    lost = rows.where(F.col(column).isNotNull()).join(there, (F.col(ENTITY) == F.col("_e")) & (F.col(column) == F.col("_k")), "left_anti").select(ENTITY).distinct().withColumn("_bad", F.lit(True))
    return named_checks(entities.select(ENTITY).join(lost, ENTITY, "left"), {name: F.col("_bad").isNull()})


def sorted_check(entities: DataFrame, rows: DataFrame, name: str, time: str = "t") -> DataFrame:
    """Whether times rise, or stay, in order of place."""
    back = rows.withColumn("_back", F.col(time) < F.lag(time).over(order("place"))).where("_back").select(ENTITY).distinct().withColumn("_bad", F.lit(True))
    return named_checks(entities.select(ENTITY).join(back, ENTITY, "left"), {name: F.col("_bad").isNull()})


def unified_checks(entities: DataFrame, tables: dict[str, DataFrame], slack: float = 1e-6) -> DataFrame:
    """Checks of the unified layer against the layers it is made from. tables: phrases, windows, accents and candidates (place, id); layer_patterns and patterns (id); anchors
    (place, t); callbacks (pattern_id, section_id) and recalls (motif_id, group_id, section_id); motifs, groups and sections (id); durations (duration, last_end)."""
    t = tables
    ends = named_checks(t["durations"], {"metadata_duration_matches_timing": F.abs(F.col("duration") - F.col("last_end")) <= slack})
    return all_checks([
        same_order_check(entities, t["phrases"], t["windows"], "timeline_phrases_match_symbolic_phrase_windows"),
        same_order_check(entities, t["accents"], t["candidates"], "accent_windows_match_energy_candidates"),
        same_set_check(entities, t["layer_patterns"], t["patterns"], "unified_pattern_ids_match_layer_d"),
        sorted_check(entities, t["anchors"], "cue_anchors_sorted_by_time"),
        references_check(entities, t["callbacks"], "pattern_id", t["patterns"], "id", "pattern_callbacks_reference_existing_patterns"),
        references_check(entities, t["callbacks"], "section_id", t["sections"], "id", "pattern_callbacks_reference_valid_sections"),
        references_check(entities, t["recalls"], "motif_id", t["motifs"], "id", "motif_callbacks_reference_existing_motifs"),
        references_check(entities, t["recalls"], "group_id", t["groups"], "id", "motif_callbacks_reference_existing_phrase_groups"),
        references_check(entities, t["recalls"], "section_id", t["sections"], "id", "motif_callbacks_reference_valid_sections"),
        ends,
    ])
