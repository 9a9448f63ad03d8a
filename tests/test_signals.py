"""Spectra, MIDI files, feature blocks, artifacts, section assembly and event records on hand-made cases and against brute force."""

import json
import os
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.operators import contracts, curves, event_records, refine, rule_events, section_assembly, sequences, spectrum, tensor
from tempora.sources import artifacts, midi
from tempora.sources.tables import artifact_dir


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


# --- spectra


def plain_frames(signal, size, hop, rate):
    """Frame by frame with numpy."""
    out, before, start = [], None, 0
    while start == 0 or start - hop + size < len(signal):
        x = np.zeros(size)
        x[: len(signal[start : start + size])] = signal[start : start + size]
        magnitude = np.abs(np.fft.rfft(x * spectrum.hann(size)))
        total = magnitude.sum()
        scaled = magnitude / max(total, 1e-8)
        loud, flux = np.sqrt(np.mean(x**2)), 0.0 if before is None else np.linalg.norm(scaled - before)
        out.append((start // hop, start / rate, loud, (magnitude * np.fft.rfftfreq(size, 1 / rate)).sum() / total if total > 0 else 0.0, flux, max(flux, loud)))
        before, start = scaled, start + hop
    return np.array(out)


@pytest.mark.parametrize("chunk", [2, 7, 256])
def test_spectra_cross_block_borders(spark, chunk):
    rate, rng = 8000.0, np.random.default_rng(1)
    at = np.arange(9001) / rate
    signals = {"tone": np.sin(2 * np.pi * 440 * at), "two": np.where(at < 0.5, np.sin(2 * np.pi * 300 * at), 0.3 * np.sin(2 * np.pi * 2500 * at)), "none": np.zeros(700), "short": np.ones(5), "one": np.array([0.5]), "noise": rng.normal(size=3000)}
    rows = []
    for name, signal in signals.items():
        edges = [0, *sorted(rng.choice(np.arange(1, len(signal)), min(len(signal) - 1, 9), replace=False).tolist()), len(signal)]
        rows += [(name, a, signal[a:b].tolist()) for a, b in zip(edges, edges[1:])]
    blocks = frame(spark, "entity_id string, start long, samples array<double>", *rows, ("empty", 0, [])).repartition(3)
    found = {}
    for r in spectrum.frame_measures(blocks, 256, 64, rate, chunk).orderBy("entity_id", "frame_index").collect():
        found.setdefault(r.entity_id, []).append(list(r)[1:])
    assert set(found) == set(signals)
    for name, signal in signals.items():
        expected = plain_frames(signal, 256, 64, rate)
        assert np.allclose(np.array(found[name], dtype=float), expected, atol=1e-9), name
    tone = np.array(found["tone"])
    assert abs(np.median(tone[:, 3]) - 440) < 25 and abs(np.median(tone[:, 2]) - np.sqrt(0.5)) < 0.02


def test_spectra_scaled_to_the_entity(spark):
    rows = frame(spark, "entity_id string, frame_index long, loudness double, spectral_flux double", ("a", 0, 2.0, 1.0), ("a", 1, 4.0, 1.0), ("b", 0, 5.0, 0.0))
    got = {(r.entity_id, r.frame_index): (r.loudness, r.spectral_flux) for r in spectrum.normalised(rows, ["loudness", "spectral_flux"]).collect()}
    assert got == {("a", 0): (0.0, 0.0), ("a", 1): (1.0, 0.0), ("b", 0): (0.0, 0.0)}


# --- MIDI files


def track(*events):
    data = b"".join(events)
    return b"MTrk" + struct.pack(">I", len(data)) + data


def file(*tracks, division=480, count=None, kind=1):
    return b"MThd" + struct.pack(">IHHH", 6, kind, len(tracks) if count is None else count, division) + b"".join(tracks)


END = b"\x00\xff\x2f\x00"


def test_midi_files(spark, tmp_path):
    tempo = track(b"\x00\xff\x51\x03\x07\xa1\x20", b"\x87\x40\xff\x51\x03\x03\xd0\x90", END)  # half a second a quarter, from tick 960 a quarter of one
    notes = track(
        b"\x00\xc9\x05", b"\x00\x99\x24\x40", b"\x83\x60\x24\x00",  # running status: velocity 0 ends the note at 480
        b"\x00\x99\x26\x50", b"\x81\x70\x26\x60", b"\x81\x70\x89\x26\x00",  # two open notes of a pitch, both ended at 960
        b"\x00\x99\x2a\x10", b"\x83\x60\xf0\x02\x01\xf7", b"\x00\x89\x2a\x10",  # over a system message, to 1440
        b"\x00\x99\x2b\x10", b"\x00\x89\x30\x00", END,
    )
    (tmp_path / "Good Song.mid").write_bytes(file(tempo, notes) + b"junk")
    (tmp_path / "frames.MIDI").write_bytes(file(track(b"\x00\x90\x3c\x40", b"\x64\x80\x3c\x00", END), division=((256 - 25) << 8) | 40))
    (tmp_path / "unknown chunk.mid").write_bytes(file(b"XXXX" + struct.pack(">I", 2) + b"ab" + track(b"\x00\x90\x3c\x40", b"\x00\x80\x3c\x00", END), count=1))
    damaged = {"no header": b"RIFF0000", "cut": file(notes)[:-10], "missing": file(notes, count=2), "within": file(track(b"\x00\x90\x3c")), "status": file(track(b"\x00\x3c\x40")), "length": file(track(b"\xff\xff\xff\xff\x7f\x90\x3c\x40")), "high": file(track(b"\x00\x90\xbc\x40")), "tempo": file(track(b"\x00\xff\x51\x02\x07\xa1", END))}
    for name, data in damaged.items():
        (tmp_path / f"{name}.mid").write_bytes(data)
    (tmp_path / "notes.txt").write_bytes(b"no midi")
    rows = midi.read_midi(spark, str(tmp_path)).collect()
    good = [(r.track, r.channel, r.program, r.pitch, r.velocity, r.start_s, r.end_s) for r in rows if r.entity_id == "Good Song"]
    assert good == [(1, 9, 5, 36, 64, 0.0, 0.5), (1, 9, 5, 38, 80, 0.5, 1.0), (1, 9, 5, 38, 96, 0.75, 1.0), (1, 9, 5, 42, 16, 1.0, 1.25)]
    assert [(r.start_s, r.end_s) for r in rows if r.entity_id == "frames"] == [(0.0, 0.1)]
    assert {r.entity_id for r in rows if r.error} == set(damaged) and all(r.pitch is None for r in rows if r.error)
    assert len([r for r in rows if r.error]) == len(damaged)
    (tmp_path / "empty.mid").write_bytes(b"")
    assert midi.read_midi(spark, str(tmp_path)).count() == len(rows)
    none = midi.midi_notes(frame(spark, "name string, content binary", ("x", None)))
    assert [(r.name, r.pitch, r.error) for r in none.collect()] == [("x", None, "byte 0: no header")]
    assert "no header" in next(r.error for r in rows if r.entity_id == "no header")


def test_midi_round_trip(spark):
    rng = random.Random(2)
    rows = []
    for song in range(3):
        at = 0
        for _ in range(200):
            at += rng.randrange(1, 20_000)
            rows.append((song, at, at + rng.randrange(1, 900_000 if rng.random() < 0.1 else 500), rng.randrange(16), rng.randrange(128), rng.randrange(1, 128)))
    # notes of a channel and pitch must not overlap, or the file does not tell them apart
    free, kept = {}, []
    for r in sorted(rows):
        if free.get((r[0], *r[3:5]), -1) < r[1]:
            free[r[0], *r[3:5]] = r[2]
            kept.append(r)
    tempos = [(0, 400_000), (5000, 700_000), (300_000, 250_000)]
    made = midi.as_midi(frame(spark, "entity_id long, start_tick long, end_tick long, channel int, pitch int, velocity int", *kept), 96, tempos)
    seconds = lambda t: sum((min(t, b) - a) * tempo / 96e6 for (a, tempo), b in zip(tempos, [5000, 300_000, 1 << 60]) if t > a)
    found = sorted((r.entity_id, r.start_s, r.end_s, r.channel, r.pitch, r.velocity) for r in midi.midi_notes(made).collect())
    expected = sorted((e, seconds(s), seconds(t), c, p, v) for e, s, t, c, p, v in kept)
    assert len(found) == len(expected) and all(np.allclose(a, b, atol=2e-6) for a, b in zip(found, expected))


# --- feature blocks


def test_feature_blocks(spark):
    rows = [(1, i, i * 100, {"a": float(i), "b": None} if i % 2 else {"c": 2.0}, {"x": 1.0} if i == 3 else None) for i in range(1, 8)] + [(2, 1, 0, {}, {"x": 5.0})]
    table = frame(spark, "entity_id long, idx int, t long, normalized map<string,double>, derived map<string,double>", *rows).repartition(3)
    keys = tensor.feature_keys(table, ["normalized", "derived"])
    assert keys == [("normalized", "a"), ("normalized", "b"), ("normalized", "c"), ("derived", "x")]
    got = {(r.entity_id, r.block): r for r in tensor.feature_blocks(table, keys, 3).collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 2), (2, 0)}
    assert got[1, 0].values == [[1.0, 0.0, 3.0], [0.0] * 3, [0.0, 2.0, 0.0], [0.0, 0.0, 1.0]] and got[1, 0].times == [100, 200, 300]
    assert got[1, 2].first_idx == 7 and got[1, 2].values == [[7.0], [0.0], [0.0], [0.0]] and got[2, 0].values[3] == [5.0]
    assert tensor.feature_keys(table.where("idx > 99"), ["derived"]) == []
    with pytest.raises(ValueError, match="features"):
        tensor.feature_keys(table, ["normalized"], most=2)


# --- artifacts


def test_artifacts_are_taken_up_again(spark, tmp_path):
    source = tmp_path / "in.parquet"
    spark.range(50).write.parquet(str(source))
    made = []

    def make():
        made.append(1)
        return spark.read.parquet(str(source)).withColumn("x", F.col("id") * 2).repartition(3)

    def run(**more):
        return sorted(r.x for r in artifacts.reusable(spark, "doubled", make, [str(source)], {"by": 2, **more}).collect())

    want = [i * 2 for i in range(50)]
    assert run() == want and run() == want and len(made) == 1
    assert run(other=1) == want and len(made) == 2  # other parameters
    (folder,) = [f for f in os.listdir(artifact_dir(spark)) if f.startswith("doubled") and json.load(open(f"{artifact_dir(spark)}/{f}/_MANIFEST.json"))["params"] == {"by": 2}]
    folder = f"{artifact_dir(spark)}/{folder}"
    data = f"{folder}/{json.load(open(f'{folder}/_MANIFEST.json'))['data']}"
    part = sorted(f for f in os.listdir(data) if f.endswith(".parquet"))[0]
    os.unlink(f"{data}/{part}")  # torn: a file is gone
    assert run() == want and len(made) == 3
    with open(f"{folder}/_MANIFEST.json", "w") as out:  # torn: half a manifest
        out.write('{"data": ')
    assert run() == want and len(made) == 4
    os.unlink(f"{folder}/_MANIFEST.json")  # never committed
    assert run() == want and len(made) == 5 and run() == want and len(made) == 5
    spark.range(60).write.mode("overwrite").parquet(str(source))
    assert len(run()) == 60 and len(made) == 6  # another input
    empty = artifacts.reusable(spark, "nothing", lambda: spark.range(0).withColumn("y", F.lit("a")), [str(tmp_path / "absent")])
    assert empty.count() == 0 and empty.dtypes == [("id", "bigint"), ("y", "string")]


# --- section assembly


def test_monotone_choice_equals_a_walk(spark):
    rng = random.Random(5)
    rows = []
    for entity in range(40):
        at = 0
        for i in range(1, 30):
            at += rng.randrange(0, 9)
            first = None if rng.random() < 0.2 else at + rng.randrange(-12, 13)
            rows.append((entity, i, first, (first if first is not None else at) + rng.randrange(-6, 7), at + rng.randrange(-4, 5)))
    found = {(r.entity_id, r.idx): r.at for r in section_assembly.monotone_choice(frame(spark, "entity_id long, idx int, offered long, first long, second long", *rows), "offered", "first", "second", "at").collect()}
    last, turned = {}, set()
    for entity, i, offered, first, second in sorted(rows, key=lambda r: r[:2]):
        takes = entity in last and offered is not None and offered > last[entity]
        last[entity] = first if takes else second
        turned.add(takes)
        assert found[entity, i] == last[entity], (entity, i)
    assert turned == {True, False}


def song(changed_at):
    """Sixteen bars of four beats, half a second each, from 0.5 s, louder from a time on; in microseconds."""
    beats = []
    for i in range(64):
        t = 500_000 + i * 500_000
        high = t >= changed_at
        beats.append((1, i + 1, t, 900 if high else 150, 850 if high else 100, 800 if high else 100))
    return beats


@pytest.mark.parametrize(("reference", "preserved", "start", "anchored"), [(False, False, 16_000_000, False), (True, False, 16_500_000, False), (False, True, 16_500_000, False), (False, False, 16_020_000, True)])
def test_sections_are_assembled(spark, reference, preserved, start, anchored):
    beats = section_assembly.novelty(frame(spark, "entity_id long, idx int, t long, energy long, onset long, flux long", *song(16_000_000)).withColumns({"v1": F.col("energy"), "v2": F.lit(1000) - F.col("energy")}), ["v1", "v2"], unit=1000.0)
    bars = frame(spark, "entity_id long, start_t long", *[(1, 500_000 + i * 2_000_000) for i in range(16)])
    groups = frame(spark, "entity_id long, idx int, start_t long, end_t long, preserve_start boolean, label string, energy double, repetition double, onset double", (1, 1, 500_000, 16_400_000, False, "a", 0.2, 0.4, 0.1), (1, 2, 16_400_000, 32_500_000, preserved, "b", 1.0, 1.0, 1.0))
    peaks = frame(spark, "entity_id long, t long, strength double", *([(1, 16_020_000, 0.4), (1, 15_990_000, 0.3), (1, 700_000, 0.9)] if anchored else []))
    got = section_assembly.assemble(groups, bars, beats, peaks, F.lit(reference)).orderBy("idx").collect()
    assert [(r.section_id, r.start_t, r.end_t, r.onset_anchored) for r in got] == [("section-001", 0, start, False), ("section-002", start, 32_500_000, anchored)]
    assert [r.confidence for r in got] == [0.515, 0.99]


def test_sections_without_bars_or_beats(spark):
    schema = "entity_id long, idx int, start_t long, end_t long, preserve_start boolean, label string, energy double, repetition double, onset double"
    groups = frame(spark, schema, (1, 1, 5, 9, False, "a", 0.0, 0.0, 0.0), (1, 2, 9, 14, False, "b", 0.0, 0.0, 0.0))
    none = frame(spark, "entity_id long, idx int, t long, contrast double, start_t long, strength double")
    got = section_assembly.assemble(groups, none, none, none).orderBy("idx").collect()
    assert [(r.start_t, r.end_t) for r in got] == [(0, 9), (9, 14)] and got[0].confidence == 0.35
    assert section_assembly.assemble(groups.where("idx > 9"), none, none, none).count() == 0


# --- event records


ROW = "entity_id long, idx int, t long, end_t long, section long, start_section long, energy_delta long, density_delta long, tension_local long, energy_score_local long, z_onset long, z_bass_activation long, z_accent_intensity long, z_energy_score long, silence_gap long, tension long, cluster int, z_vocal_presence long"


def feature_rows():
    names = [c.split()[0] for c in ROW.split(", ")][5:]
    base = {"energy_score_local": 300_000, "z_energy_score": 500_000, "cluster": 1}
    special = {3: {"energy_delta": 2_000_000, "tension_local": 900_000, "energy_score_local": 900_000}, 12: {"silence_gap": 600_000, "z_energy_score": 0, "cluster": 0, "tension_local": 950_000}, 14: {"energy_delta": 4_000_000, "z_onset": 700_000, "z_bass_activation": 300_000, "z_accent_intensity": 900_000, "cluster": 2}, 22: {"energy_delta": -3_000_000, "density_delta": -600_000, "cluster": 0}, 23: {"energy_delta": 900_000}, 30: {"z_accent_intensity": 650_000}, 36: {"silence_gap": 700_000, "z_energy_score": 100_000, "cluster": 0, "tension_local": 990_000}}
    special[4] = special[3]
    return [(1, i, i * 1_000_000, (i + 1) * 1_000_000, 1 if i < 20 else 2, *[{"start_section": 1 if i < 20 else None, **base, **special.get(i, {})}.get(n, 0) for n in names]) for i in range(1, 41)]


def test_event_records_meet_their_contract(spark):
    rows = rule_events.with_thresholds(frame(spark, ROW, *feature_rows()))
    found = rule_events.rule_candidates(rows)
    sections = frame(spark, "entity_id long, section long, start_t long, end_t long, section_character string", (1, 1, 0, 20_000_000, "groove_plateau"))
    records = event_records.rule_records(found, rule_events.section_candidates(rows, found), sections)
    got = {r.id: r.record for r in records.collect()}
    assert {"rule_build_001", "rule_drop_001", "rule_breakdown_001", "rule_impact_hit_001", "rule_pause_break_001", "rule_pause_break_002", "rule_fake_drop_001"} <= set(got)
    build, drop, fake = got["rule_build_001"], got["rule_drop_001"], got["rule_fake_drop_001"]
    assert (build.start_time, build.end_time, build.section_id, build.section_name) == (3.0, 5.0, "section-002", "groove_plateau")
    assert [(m.name, m.value) for m in build.evidence.metrics] == [("energy_mean", 0.9), ("harmonic_tension_mean", 0.9)]
    assert build.evidence.source_windows[0].ref == "beats:3-4" and build.candidates[0].type == "tension_hold" and build.candidates[0].confidence == 0.8
    assert [m.threshold for m in drop.evidence.metrics[1:]] == [0.45, 0.25, 0.25] and drop.candidates[0].confidence == 1.0
    assert fake.section_id is None and len(fake.evidence.source_windows) == 1 and fake.start_time == 36.0
    documents = event_records.as_documents(records)
    assert contracts.check_documents(documents, contracts.EVENT, "event", "id").collect() == []
    spoilt = documents.withColumn("document", F.regexp_replace("document", '"notes":"[^"]*",', ""))
    assert {r.violation for r in contracts.check_documents(spoilt, contracts.EVENT, "event", "id").collect()} >= {"event.notes:missing"}


def test_refined_records(spark):
    rows = rule_events.with_thresholds(frame(spark, ROW, *feature_rows()))
    found = rule_events.rule_candidates(rows)
    sections = frame(spark, "entity_id long, section long, start_t long, end_t long, section_character string", (1, 1, 0, 20_000_000, "groove_plateau"))
    records = event_records.rule_records(found, rule_events.section_candidates(rows, found), sections).withColumn("section_character", F.coalesce("section_character", F.lit("")))
    opened = frame(spark, "entity_id long, id string, spectral_centroid_delta long", (1, "rule_drop_001", 500))
    for identifiers, layers, kind in ((opened, 3, "drop"), (None, 2, "drop_punch")):
        refined = event_records.refined_records(refine.refine_candidates(records, rows, 2_000_000, 4_000_000, key="id", identifiers=identifiers))
        got = {r.id: r.refined_record for r in refined.collect()}
        drop = got["rule_drop_001"]
        # accent .9, delta 4, onset .7, bass .3, local energy .3; an open spectrum adds a fifth to an explosive drop, which a punch is then near
        assert (drop.type, len(drop.source_layers), len(drop.candidates)) == (kind, layers, 4) and drop.id.startswith(f"machine_{kind}_")
        assert drop.candidates[0].confidence == (0.915 if identifiers is not None else 0.89)
        assert got["rule_build_001"].candidates is None and got["rule_build_001"].notes.startswith("Merged")
        reset = got["rule_breakdown_001"]
        assert reset.type == "energy_reset" and [c.type for c in reset.candidates] == ["energy_reset", "breakdown"] and "reset-and-reentry" in reset.notes
        documents = event_records.as_documents(refined, "refined_record", "refined_id")
        assert contracts.check_documents(documents, contracts.EVENT, "event", "refined_id").collect() == []


def test_intensity_falls_back(spark):
    rows = frame(spark, "given double, accent double, energy double, bass double, n long, confidence double", (0.3, 0.9, 0.9, 0.9, 4, 0.9), (None, 0.2, 0.7, 0.1, 4, 0.5), (None, 0.2, 0.1, 0.1, 4, 0.5), (None, 0.9, 0.9, 0.9, 0, 0.4), (1.7, 0.0, 0.0, 0.0, 0, 0.0))
    got = [r.x for r in rows.select(refine.intensity_of(*[F.col(c) for c in rows.columns]).alias("x")).collect()]
    assert got == [0.3, 0.7, 0.5, 0.4, 1.0]


# --- cooldowns


@pytest.mark.parametrize("strict", [False, True])
def test_cooldowns_equal_a_walk(strict):
    rng = random.Random(6)
    for _ in range(300):
        n, gap = rng.randrange(1, 60), rng.choice([0, 1, 3, 10])
        entity = np.sort(np.array([rng.randrange(3) for _ in range(n)]))
        t = np.concatenate([np.sort([rng.randrange(40) for _ in range((entity == e).sum())]) for e in range(3)]).astype(np.int64)
        want, last = [], {}
        for i in range(n):
            e = entity[i]
            if e not in last or t[i] - last[e] > gap or (t[i] - last[e] == gap and not strict):
                last[e] = t[i]
                want.append(i)
        got, held, before = [], None, None
        cuts = sorted({0, n, *[rng.randrange(n + 1) for _ in range(3)]})
        for a, b in zip(cuts, cuts[1:]):  # batches cut anywhere
            first = np.concatenate([[before is None or before != entity[a]], np.diff(entity[a:b]) != 0])
            places, held = sequences.kept_rows(t[a:b], first, gap, strict, held)
            got += (places + a).tolist()
            before = entity[b - 1]
        assert got == want


# --- curves


def test_novelty_is_a_checkerboard_over_similarities(spark):
    rng = np.random.default_rng(4)
    for taper in ([1] * 3, [3, 2, 1]):
        x = rng.integers(-9, 10, (20, 2))
        rows = frame(spark, "entity_id long, idx int, a long, b long", *[(1, i + 1, int(a), int(b)) for i, (a, b) in enumerate(x)])
        got = {r.idx: r.novelty for r in curves.novelty_curve(rows, ["a", "b"], 3, taper).collect()}
        like = x @ x.T
        for i in range(20):
            if i < 3 or i > 17:
                assert got[i + 1] is None
                continue
            kernel = sum(g * h * (like[i + j, i + k] + like[i - 1 - j, i - 1 - k] - like[i + j, i - 1 - k] - like[i - 1 - j, i + k]) for j, g in enumerate(taper) for k, h in enumerate(taper))
            assert got[i + 1] == pytest.approx(kernel / sum(taper) ** 2)


def test_periods_of_planted_pulses(spark):
    rng = random.Random(8)
    rows = [(e, i + 1, (100 if i % period == 0 else 0) + rng.randrange(10)) for e, period in ((1, 5), (2, 7)) for i in range(200)] + [(3, i + 1, 5) for i in range(30)] + [(4, 1, 5)]
    table = frame(spark, "entity_id long, idx int, x long", *rows)
    found = curves.autocorrelation(table, "x", 12)
    values = {(r.entity_id, r.lag): r.correlation for r in found.collect()}
    for e in (1, 2):
        x = np.array([v for k, _, v in rows if k == e], dtype=float)
        x -= x.mean()
        for lag in range(1, 13):
            assert values[e, lag] == pytest.approx((x[:-lag] * x[lag:]).sum() / (x**2).sum(), abs=1e-8)
    assert values[3, 1] is None and (4, 1) not in values
    assert {r.entity_id: r.period for r in curves.periods(found).collect()} == {1: 5, 2: 7}


def test_local_keys_of_scales(spark):
    scale = [0, 2, 4, 5, 7, 9, 11]
    weight = {0: 5, 7: 4, 4: 3}
    notes = [(1, s, 60 + t + n, weight.get(n, 1)) for s, t in ((0, 0), (1, 7)) for n in scale] + [(1, 2, 60 + n, w) for n, w in ((9, 5), (0, 4), (4, 4), (2, 1), (11, 1), (5, 1), (7, 1))] + [(1, 3, i, 1) for i in range(12)]
    got = {r.section: r for r in curves.local_keys(frame(spark, "entity_id long, section long, pitch long, w long", *notes), "section", F.col("w")).collect()}
    assert {s: r.key for s, r in got.items()} == {0: "C major", 1: "G major", 2: "A minor"} and got[0].margin > 0  # all pitch classes alike: no key
    counts = np.zeros(12)
    for _, s, p, w in notes:
        if s == 0:
            counts[p % 12] += w
    assert got[0].score == pytest.approx(np.corrcoef(counts, curves.MAJOR_PROFILE)[0, 1], abs=1e-8)


def test_channels_equal_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 6)) @ np.diag([9, 5, 3, 1, 0.5, 0.1]) @ np.linalg.qr(rng.normal(size=(6, 6)))[0] + 4
    rows = frame(spark, "vec_id long, label int, v array<double>", *[(i, i % 3, row.tolist()) for i, row in enumerate(x)], (900, 1, None), (901, 2, [1.0]))
    mean, axes, variances = curves.principal_axes(rows.repartition(5), "v", 6, 3)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(variances, values[::-1][:3])
    assert np.allclose(np.abs(axes @ vectors[:, ::-1][:, :3]), np.eye(3), atol=1e-6)
    got = {r.vec_id: r for r in curves.drift(curves.channels(rows, "v", mean, axes), "label", "vec_id").collect()}
    own = (x - x.mean(axis=0)) @ axes.T
    for i in range(300):
        assert np.allclose(got[i].channels, own[i])
        assert got[i].drift == pytest.approx(0.0 if i < 3 else np.linalg.norm(own[i] - own[i - 3]))
    assert got[900].channels is None and got[900].drift is None and got[901].channels is None
