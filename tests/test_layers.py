"""The symbolic layer, smoothing, phrase groups, validators and section hints on hand-made cases and against plain walks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.operators import cards, features, joins, layer_checks, section_hints, sequences, symbolic, texts


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


NOTES = "entity_id long, event_id long, source string, t long, length long, pitch int, confidence long"
SECOND = 1_000_000


def song_of(spark, notes):
    beats = frame(spark, "entity_id long, idx int, bar long, t long, end_t long", *[(1, i + 1, i // 4 + 1, i * SECOND // 2, (i + 1) * SECOND // 2) for i in range(32)])
    bars = frame(spark, "entity_id long, bar long, start_t long, end_t long", *[(1, b + 1, b * 2 * SECOND, (b + 1) * 2 * SECOND) for b in range(8)])
    sections = frame(spark, "entity_id long, section long, start_t long, end_t long", (1, 0, 0, 8 * SECOND), (1, 1, 8 * SECOND, 16 * SECOND))
    return symbolic.symbolic_layer(frame(spark, NOTES, *notes), beats, bars, sections, 2 * SECOND)


def test_symbolic_layer(spark):
    rng = random.Random(1)
    notes = [(1, i, "bass", i * SECOND, SECOND, 40 + i % 2, 900_000) for i in range(16)]
    notes += [(1, 100 + i, "harmonic", i * SECOND + 400_000, 300_000, 60 + i, 500_000) for i in range(16)]  # 0.1 s off the beat
    notes += [(1, 200 + i, "vocals", i * SECOND, 200_000, rng.choice([50, 52]), 900_000) for i in range(10)]  # too low to be vocals
    notes += [(1, 300 + i, "full_mix", i * SECOND + 10_000, 100_000, 40 + i % 2, 400_000) for i in range(5)]  # the bass once more
    notes += [(1, 400 + i, "drums", i * SECOND, 100_000, 36, 990_000) for i in range(5)]
    layer = song_of(spark, notes)
    quality = {r.source: r for r in layer.quality.collect()}
    assert {s: r.decision for s, r in quality.items()} == {"bass": "promoted", "harmonic": "promoted", "vocals": "auxiliary_only", "full_mix": "promoted", "drums": "auxiliary_only"}
    assert quality["bass"].low_register_ratio == 1.0 and quality["harmonic"].alignment_resolved_ratio == 1.0 and quality["full_mix"].confidence_mean == 0.4 and quality["drums"].reason.startswith("percussive")
    kept = layer.notes.collect()
    assert {r.source for r in kept} == {"bass", "harmonic"} and len(kept) == 32  # the mix repeats the bass
    bars = {r.bar: r for r in layer.bars.collect()}
    assert bars[1].note_count == 4 and bars[1].density == 1.0 and bars[1].active_note_peak == 1 and bars[1].centroid == 60_500_000 and bars[1].register_label == "mid"
    sections = {r.section: r for r in layer.sections.collect()}
    assert sections[0].melodic_contour == "rising" and sections[0].bar_end == 4 and sections[0].register_centroid == 63.5 and sections[0].sustain_ratio == 0.5 and sections[0].texture == "melodic"
    beats = {r.idx: (r.note_count, r.density) for r in layer.beats.collect()}
    assert beats[1] == (2, 4.0) and beats[2] == (2, 4.0) and len(beats) == 32
    (card,) = layer.songs.collect()
    assert (card.note_count, card.pitch_min, card.pitch_max, card.bass_motion) == (32, 40, 75, "stepwise")


def test_symbolic_layer_of_silence(spark):
    layer = song_of(spark, [(1, 1, "bass", 0, SECOND, 90, 900_000)])  # a bass that is none
    assert [r.decision for r in layer.quality.collect()] == ["rejected"] and layer.notes.count() == 0
    assert {r.texture for r in layer.sections.collect()} == {"sparse"} and {r.note_count for r in layer.bars.collect()} == {0}
    (card,) = layer.songs.collect()
    assert (card.note_count, card.pitch_min, card.bass_motion) == (0, None, "minimal")


def test_chords_are_smoothed_where_the_key_is_sure(spark):
    rng = random.Random(4)
    names = ["C", "Am", "F", "G", "C#m", "N", None]
    rows = [(e, i, rng.choices(names, [9, 5, 5, 5, 2, 1, 1])[0]) for e in range(8) for i in range(1, 40 if e else 2)]
    keys = [(e, e % 12, e % 2 == 0, [0.8, 0.5, 0.49][e % 3]) for e in range(7)]  # entity 7 has no key
    found = {(r.entity_id, r.idx): r.label for r in sequences.smooth_chords(frame(spark, "entity_id long, idx int, label string", *rows), frame(spark, "entity_id long, tonic int, major boolean, confidence double", *keys)).collect()}
    for e in range(8):
        labels = [name for x, _, name in rows if x == e]
        if e == 7 or keys[e][3] < 0.5 or len(labels) < 2:
            assert [found[e, i + 1] for i in range(len(labels))] == labels
            continue
        moves = sequences.chord_moves(keys[e][1], keys[e][2])
        place = {c: i for i, c in enumerate(sequences.CHORDS)}
        hear = [[np.log(0.95) if place.get(name) == s else np.log(0.05 / 23) for s in range(24)] for name in labels]
        best, paths = hear[0], [[s] for s in range(24)]
        for t in range(1, len(labels)):  # whole paths, kept for each chord
            prev = [max(range(24), key=lambda p, s=s: (best[p] + moves[p, s], -p)) for s in range(24)]
            best, paths = [best[prev[s]] + moves[prev[s], s] + hear[t][s] for s in range(24)], [[*paths[prev[s]], s] for s in range(24)]
        path = paths[max(range(24), key=lambda s: (best[s], -s))]
        assert [found[e, i + 1] for i in range(len(labels))] == [sequences.CHORDS[s] for s in path]
    assert np.allclose(np.exp(sequences.chord_moves(0, True)[0]).sum(), 0.7 + 0.25 * 5 / 6 + 0.05 * 18 / 17)


def test_phrase_groups_equal_a_walk(spark):
    rng = random.Random(7)
    base = [[rng.random() for _ in range(4)] for _ in range(5)]
    rows = []
    for e in range(3):
        for i in range(60):
            v = [x + rng.gauss(0, 0.08) for x in rng.choice(base)]
            rows.append((e, i, rng.choice([2, 4]), rng.choice(["rising", "static"]), rng.choice([None, 60.0, 63.0, 67.0]), rng.choice([2.0, 2.5, 4.0]), rng.sample(range(4), 3), v if rng.random() < 0.95 else [0.0] * 4))
    found = {(r.entity_id, r.idx): r.group_idx for r in sequences.phrase_groups(frame(spark, "entity_id long, idx int, bar_count int, contour string, centroid double, density double, classes array<int>, vector array<double>", *rows)).collect()}
    for e in range(3):
        groups = []
        for _, i, bars, contour, centroid, density, classes, vector in (r for r in rows if r[0] == e):
            best, most = None, 0.0
            for g in groups:
                if (g["bars"], g["contour"]) != (bars, contour) or (g["c"] is not None and centroid is not None and abs(g["c"] - centroid) > 4.5):
                    continue
                if abs(g["d"] - density) / max(g["d"], 1.0) > 0.3 or len(g["k"] & set(classes)) < 2:
                    continue
                norm = np.linalg.norm(g["v"]) * np.linalg.norm(vector)
                like = np.dot(g["v"], vector) / norm if norm else 0.0
                if like > most:
                    best, most = g, like
            if best is None or most < 0.97:
                best = {"bars": bars, "contour": contour, "c": centroid, "d": density, "k": set(classes), "v": np.array(vector), "n": 1, "first": i}
                groups.append(best)
            else:
                n = best["n"]
                best["v"], best["d"], best["n"] = (best["v"] * n + np.array(vector)) / (n + 1), (best["d"] * n + density) / (n + 1), n + 1
                if best["c"] is None:
                    best["c"] = centroid
                elif centroid is not None:
                    best["c"] = (best["c"] * n + centroid) / (n + 1)
            assert found[e, i] == best["first"]
        assert 2 < len(groups) < 55


def test_chord_report(spark):
    reference = frame(spark, "entity_id long, idx int, t long, label string", *[(e, i + 1, i * 10, "C" if i < 4 else "F") for e in (1, 2) for i in range(9)])
    chords = [(1, 1, 0, 40, "C"), (1, 2, 40, 80, "F"), (2, 3, 0, 40, "C"), (2, 4, 35, 60, "Am"), (2, 5, 70, 200, "F"), (2, 6, 500, 600, "F")]
    results = layer_checks.chord_results(frame(spark, "entity_id long, event_id long, start_t long, end_t long, label string", *chords), reference, 40)
    assert {r.event_id: (r.result, r.overlap_ratio) for r in results.collect()} == {1: ("matched", 1.0), 2: ("matched", 1.0), 3: ("matched", 1.0), 4: ("label_mismatch", 0.8), 5: ("timing_overlap_failure", 0.076923), 6: ("no_reference_overlap", 0.0)}
    got = {r.entity_id: r for r in layer_checks.chord_report(results).collect()}
    assert (got[1].status, got[1].match_ratio, got[2].status, got[2].mismatched, got[2].median_overlap_ratio) == ("passed", 1.0, "failed", 3, 0.438462)


def test_drum_and_pattern_checks(spark):
    schema = "entity_id long, place int, event_id long, t long, kind string, resolved boolean, aligned_bar int, aligned_beat int, aligned_idx int"
    good = [(1, i, i, i * 250, ["kick", "hat", "snare", "hat"][i % 4], True, i // 8 + 1, i // 2 % 4 + 1, i // 2 + 1) for i in range(32)]
    bad = [(2, 0, 7, 100, "kick", True, None, 1, 1), (2, 1, 7, 50, "bell", False, None, None, None)]
    counts = "entity_id long, event_count long, kick_count long, snare_count long, hat_count long, unresolved_count long"
    hits = frame(spark, schema, *good, *bad)
    checks = layer_checks.drum_checks(hits, frame(spark, counts, (1, 32, 8, 8, 16, 0), (2, 2, 1, 0, 0, 1), (3, 0, 0, 0, 0, 0)))
    failed = {}
    for r in checks.collect():
        failed.setdefault(r.entity_id, set()).update([] if r.passed else [r.check])
    assert failed == {1: set(), 2: {"event_ids_unique", "event_times_sorted", "event_types_supported", "summary_counts_match_event_rows", "resolved_events_have_alignment_fields"}, 3: {"drum_events_present"}}
    assert {r.entity_id: r.status for r in layer_checks.check_report(checks).collect()} == {1: "passed", 2: "failed", 3: "failed"}
    beats = frame(spark, "entity_id long, t long", *[(1, i * 1000) for i in range(9)])
    d = {r.entity_id: r for r in layer_checks.drum_diagnostics(hits, beats).collect()}
    assert (d[1].recognizable_hat_pulse, d[1].overdense_hat_regions, d[1].hat_interval, d[2].recognizable_hat_pulse) == (True, 0, 500.0, False)
    patterns = frame(spark, "entity_id long, pattern string, bar_count int, occurrence_count int", (1, "a", 2, 2), (1, "b", 30, 1), (1, "c", 3, 0))
    occurrences = frame(spark, "entity_id long, pattern string, start_bar int, end_bar int", (1, "a", 1, 2), (1, "a", 2, 3), (1, "b", 5, 9))
    got = {r.check: r.passed for r in layer_checks.pattern_checks(patterns, occurrences, frame(spark, "entity_id long, bar int", (1, 8)), frame(spark, "entity_id long, pattern_count int", (1, 3))).collect()}
    assert {c for c, ok in got.items() if not ok} == {"a_occurrences_non_overlapping", "b_bar_count_range", "b_occurrence_lengths_match_bar_count"} and len(got) == 14


def test_hints_of_a_section(spark):
    sections = frame(spark, "entity_id long, section long, section_id string, start_t long, label string", (1, 0, "section-001", 0, "contrast_bridge"), (1, 1, "section-002", 12_340_000, "groove_plateau"), (1, 2, "section-003", 30_000_000, "groove_plateau"))
    cards = frame(spark, "entity_id long, section long, texture string, melodic_contour string, density_mean double, sustain_ratio double, repetition_score double", (1, 1, "layered", "rising", 12.5, 0.05, 0.8), (1, 2, "sparse", "static", None, None, 0.2))
    phrases = frame(spark, "entity_id long, section long, phrase_id string, phrase_group string, start_t long", *[(1, 1, f"p{i}", "gA" if i % 2 else "gB", i) for i in range(6)], (1, 2, "p9", "gC", 9), (1, None, "p10", "gA", 10))
    repeated = frame(spark, "entity_id long, phrase_group string, place int, motif string", (1, "gA", 1, "motif_alpha"), (1, "gB", 2, None))
    got = {r.id: r for r in section_hints.section_hints(sections, cards, phrases, repeated).collect()}
    assert set(got) == {"section-002-inference-transition_role", "section-002-inference-section_shape", "section-002-inference-phrase_boundaries", "section-002-inference-motif_recall", "section-003-inference-section_shape", "section-003-inference-phrase_boundaries", "section-003-inference-variation_rule"}
    assert got["section-002-inference-transition_role"].text == "Treat 12.34s as the main cue reset into this groove plateau; let the new pulse state land on the boundary instead of drifting late."
    assert got["section-002-inference-section_shape"].text == "groove plateau reads as a layered section with rising contour, dense activity, and mostly short notes."
    recall = got["section-002-inference-motif_recall"]
    assert "gA, gB via motifs motif_alpha;" in recall.text and recall.phrase_window_ids == ["p0", "p1", "p2", "p3"] and recall.motif_group_ids == ["motif_alpha"]
    assert "unknown activity, and unknown sustain" in got["section-003-inference-section_shape"].text and "occasional repetition" in got["section-003-inference-variation_rule"].text
    given = frame(spark, "entity_id long, section_id string, place int, id string, category string, text string", (1, "section-002", 0, "mine", "note", "x"), (1, "section-900", 0, "old", "note", "y"))
    merged = {r.id: (r.source, r.preserved) for r in section_hints.merged_hints(section_hints.section_hints(sections, cards, phrases, repeated).withColumn("section_id", F.regexp_extract("id", r"^(section-\d+)", 1)), given).collect()}
    assert merged["mine"] == ("user", False) and merged["old"] == ("user", True) and len(merged) == 9


def plain_patterns(grid, longest, tolerated):
    """Every start against every other, anew for each pattern."""
    n, used, out = len(grid), np.zeros(len(grid), dtype=bool), []
    weights = sequences.PATTERN_SCORE
    while True:
        best = None
        for length in [4, *range(min(longest, n // 2), 1, -1)]:
            starts = [s for s in range(n - length + 1) if not used[s : s + length].any()]
            for first in starts:
                found, errors, free = [], [], 0
                for s in starts:
                    wrong = int((grid[s : s + length] != grid[first : first + length]).sum())
                    if s >= max(first, free) and wrong <= (0 if length == 2 else tolerated):
                        found.append(s)
                        errors.append(wrong)
                        free = s + length
                if len(found) >= 2:
                    score = weights["bars"] * len(found) * length + weights["length"] * length + weights["found"] * len(found) + weights["four"] * (length == 4) - weights["error"] * sum(errors)
                    if best is None or score > best[0]:
                        best = (score, length, found, errors)
        if best is None:
            return out
        out.append(best[1:])
        for s in best[2]:
            used[s : s + best[1]] = True


def test_patterns_equal_a_plain_search():
    rng = np.random.default_rng(9)
    for trial in range(40):
        n = int(rng.integers(0, 40))
        units = rng.integers(0, 3, (3, int(rng.integers(1, 6)), 4))
        grid = np.concatenate([units[rng.integers(0, 3)] for _ in range(12)])[:n].astype(np.int32).reshape(-1, 4)
        noise = rng.random(grid.shape) < rng.choice([0.0, 0.05, 0.3])
        grid = np.where(noise, rng.integers(0, 4, grid.shape), grid).astype(np.int32)
        longest, tolerated = int(rng.choice([3, 8, 24])), int(rng.choice([0, 1, 3]))
        assert list(sequences.PatternMiner(grid, longest, tolerated).patterns()) == plain_patterns(grid, longest, tolerated)


def test_energy_clusters_of_planted_levels(spark):
    rng = random.Random(2)
    rows = [(1, i, level * 100.0 + rng.gauss(0, 4), level * 7.0 + rng.gauss(0, 1), float(level)) for i, level in enumerate(rng.choices([0, 1, 2], k=90))] + [(2, 1000 + i, float(i), 0.0, 0.0) for i in range(10)]
    table = frame(spark, "entity_id long, event_id long, energy double, k double, level double", *rows).repartition(3)
    found = {r.event_id: r.cluster for r in features.energy_clusters(table, ["energy", "k"]).collect()}
    assert all(found[i] == int(level) for e, i, _, _, level in rows if e == 1)
    assert {found[1000 + i] for i in range(10)} == {2}  # too few rows to tell
    assert found == {r.event_id: r.cluster for r in features.energy_clusters(table, ["energy", "k"]).collect()}


def test_one_decimal_is_that_of_the_binary_value(spark):
    rng = random.Random(3)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 0.75, 16.45, 12.25, 9.95, 2.675, 1e6 + 0.05] + [rng.randrange(0, 100_000) / 100 for _ in range(500)] + [rng.random() * 50 for _ in range(200)]
    rows = frame(spark, "i int, x double", *enumerate([*values, None]))
    got = {r.i: r.t for r in rows.select("i", texts.one_decimal(F.col("x")).alias("t")).collect()}
    assert all(got[i] == f"{x:.1f}" for i, x in enumerate(values)) and got[len(values)] == "n/a"


def test_codes_of_many_groups(spark):
    def code(n):
        out = ""
        while n >= 0:
            out, n = chr(65 + n % 26) + out, n // 26 - 1
        return out

    numbers = [0, 1, 25, 26, 27, 51, 52, 701, 702, 703, 18_277, 18_278, 475_253, 10**12]
    rows = frame(spark, "n long", *[(n,) for n in numbers])
    assert {r.n: r.c for r in rows.select("n", cards.group_code(F.col("n")).alias("c")).collect()} == {n: code(n) for n in numbers}


def test_range_joins_refuse_a_width_that_does_not_suit(spark):
    rows, spans = frame(spark, "entity_id long, t long", (1, 5)), frame(spark, "entity_id long, start_t long, end_t long", (1, 0, 10_000_000))
    assert joins.in_range(rows, spans, 1000).count() == 1
    with pytest.raises(Exception, match="larger width"):
        joins.in_range(rows, spans, 10).collect()


def test_densities_are_added_in_the_order_of_place(spark):
    rows = [(1, "a", 0, 55.3), (1, "a", 1, 78.4), (1, "a", 3, 39.7), (1, "a", 2, 12.4)]  # 46.45 by place, a little less as they stand
    phrases = frame(spark, "entity_id long, phrase_group string, place long, density double", *rows).coalesce(1)
    named = phrases.withColumns({"label": F.lit("Group a"), "section_name": F.lit("s"), "melodic_contour": F.lit("flat")})
    assert [r.description[-21:] for r in texts.phrase_group_descriptions(named).collect()] == ["(46.5 notes per bar)."]


def test_phrase_groups_stream_over_many_small_groups(spark):
    kind = "entity_id long, idx long, bar_count long, contour string, centroid double, density double, classes array<int>, vector array<double>"
    rows = [(e, i, 2 + i % 2, None if i % 4 == 3 else "static", None, 2.0, [0, 4, 7], [1.0, 2.0]) for e in [*range(50), None] for i in range(6)]
    grouped = sequences.phrase_groups(frame(spark, kind, *rows))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "GroupsInPandas" not in plan  # a call of Python for each group took most of the time
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # groups go on from one batch to the next
    try:
        found = {(r.entity_id, r.idx, r.group_idx) for r in grouped.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {(e, i, {0: 0, 2: 0, 4: 0, 1: 1, 5: 1, 3: 3}[i]) for e in [*range(50), None] for i in range(6)}
