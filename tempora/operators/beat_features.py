"""The wide feature row of each beat: tracks joined on the grid, scores against the entity's statistics,
derived scores and rolling means.

Scores are whole millionths. Sums of them are exact in whatever order Spark adds them up, so thresholds
and means do not depend on how rows are dealt out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins, windows
from .windows import ENTITY

MILLION = 1_000_000
#: Numeric features of a row, in the order of the feature catalogue. Fixed values.
FEATURES = [
    "loudness", "onset", "flux", "centroid", "energy_score", "density", "vocal_presence", "bass_activation",
    "vocals_stem", "drums_stem", "harmonic_stem", "bass_stem", "accent_intensity", "chord_confidence",
]
#: Rows of the rolling means by name. Fixed values.
ROLLING = {"local": 1, "phrasal": 16, "structural": 128}
ROLLED = ["z_energy_score", "z_density", "z_vocal_presence", "z_bass_activation", "tension"]


@dataclass
class Tracks:
    """What is joined to the beats (entity_id, idx, t, end_t). Of tracks by beat (entity_id, idx): energy
    (loudness, onset, flux, centroid), density (density, note_count), stems (vocals_stem, drums_stem,
    harmonic_stem, bass_stem). Of intervals (entity_id, start_t, end_t): sections (section), phrases (phrase),
    chords (chord, chord_confidence), notes (stem). Of points: accents (accent_id, at, intensity)."""

    energy: DataFrame
    density: DataFrame
    stems: DataFrame
    sections: DataFrame
    phrases: DataFrame
    chords: DataFrame
    notes: DataFrame
    accents: DataFrame


def energy_score(loudness: Column, flux: Column, onset: Column) -> Column:
    """Weighted energy: half loudness, a quarter each of flux and onset density."""
    return loudness * F.lit(0.5) + flux * F.lit(0.25) + onset * F.lit(0.25)


def first_point(windows_: DataFrame, points: DataFrame, width: int, key: str = "idx") -> DataFrame:
    """(entity_id, key, first): the first point (at, then id) within start_t <= at < end_t of each window."""
    names = [c for c in points.columns if c != ENTITY]
    met = joins.in_range(points, windows_.select(ENTITY, key, "start_t", "end_t"), width, time="at")
    return met.groupBy(ENTITY, key).agg(F.min(F.struct("at", *[c for c in names if c != "at"])).alias("first"))


def note_cover(windows_: DataFrame, notes: DataFrame, width: int, stems: list[str]) -> DataFrame:
    """(entity_id, idx, cover_<stem>): how much of each window the notes of a stem cover, summed over notes,
    at most 1, in whole millionths."""
    a = windows_.select(ENTITY, "idx", F.col("start_t").alias("a_start"), F.col("end_t").alias("a_end"))
    b = notes.select(ENTITY, "stem", F.col("start_t").alias("b_start"), F.col("end_t").alias("b_end"))
    pairs = joins.overlapping(a, b, width)
    length = F.greatest(F.lit(1), F.max(F.col("a_end") - F.col("a_start")))
    share = lambda s: F.least(F.lit(MILLION), F.floor(F.coalesce(F.sum(F.when(F.col("stem") == s, F.col("shared"))), F.lit(0)) * MILLION / length))
    return pairs.groupBy(ENTITY, "idx").agg(*[share(s).cast("long").alias(f"cover_{s}") for s in stems])


def beat_rows(beats: DataFrame, tracks: Tracks, width: int) -> DataFrame:
    """A row for each beat with every feature: sections and phrases at its middle, chords at its start (the
    last one beyond the end of a track), the first accent within it, note cover, and zeros where a track
    has no row. ``width`` is the bucket of the range joins, near the length of a beat."""
    spans = beats.select(ENTITY, "idx", F.col("t").alias("start_t"), "end_t")
    middle = beats.withColumn("_m", F.floor((F.col("t") + F.col("end_t")) / 2).cast("long"))
    named = joins.containing(middle, tracks.sections, time="_m", fallback_last=True).withColumn("section", F.col("inside.section")).drop("inside")
    named = joins.containing(named, tracks.phrases, time="_m", fallback_last=True).withColumn("phrase", F.col("inside.phrase")).drop("inside", "_m")
    named = joins.containing(named, tracks.chords, fallback_last=True).withColumns({"chord": F.coalesce("inside.chord", F.lit("N")), "chord_confidence": F.coalesce("inside.chord_confidence", F.lit(0))}).drop("inside")
    accent = first_point(spans, tracks.accents, width).select(ENTITY, "idx", F.col("first.accent_id").alias("accent_id"), F.col("first.intensity").alias("accent_intensity"))
    cover = note_cover(spans, tracks.notes, width, ["vocals", "bass"]).withColumnsRenamed({"cover_vocals": "vocal_presence", "cover_bass": "bass_activation"})
    wide = reduce(lambda a, b: a.join(b, [ENTITY, "idx"], "left"), [named, tracks.energy, tracks.density, tracks.stems, accent, cover])
    filled = wide.fillna(0, [c for c in FEATURES if c not in ("energy_score", "chord_confidence")] + ["note_count"])
    scored = filled.withColumn("energy_score", energy_score(F.col("loudness"), F.col("flux"), F.col("onset")))
    scored = scored.withColumn("chord_change", F.when(F.lag("chord").over(windows.order()) != F.col("chord"), 1).otherwise(0))
    return windows.silence(scored, F.col("note_count"), F.greatest(F.col("end_t") - F.col("t"), F.lit(1))).withColumnRenamed("gap", "silence_gap")


def scored(rows: DataFrame, features: list[str] = FEATURES, unit: dict[str, int] | None = None) -> DataFrame:
    """rows with ``z_<feature>``, the score of each feature against the entity's mean and population
    deviation, in whole millionths; 0 where the deviation is below 1e-9. ``unit`` names features that are
    whole only when multiplied by a number. Statistics are partial sums by entity, joined back; rows are best a table, as they
    are read twice."""
    unit = unit or {"energy_score": 4}
    exact = {f: (F.col(f) * unit.get(f, 1)).cast("decimal(19,0)") for f in features}
    sums = [F.count("*").alias("_n")]
    for f, x in exact.items():
        sums += [F.sum(x).cast("decimal(38,0)").alias(f"_s_{f}"), F.sum((x * x).cast("decimal(37,0)")).cast("decimal(38,0)").alias(f"_q_{f}")]
    n, columns = F.col("_n"), []
    for f in features:
        by, s, q = unit.get(f, 1), F.col(f"_s_{f}"), F.col(f"_q_{f}")
        spread = (n.cast("decimal(38,0)") * q - s * s).cast("double")
        columns += [F.round(s.cast("double") / n / by, 6).alias(f"_m_{f}"), F.round(F.sqrt(spread) / n / by, 6).alias(f"_d_{f}")]
    joined = rows.join(rows.groupBy(ENTITY).agg(*sums).select(ENTITY, *columns), ENTITY)
    score = lambda f: F.when(F.col(f"_d_{f}") < 1e-9, F.lit(0.0)).otherwise((F.col(f) - F.col(f"_m_{f}")) / F.col(f"_d_{f}") * MILLION)
    return joined.withColumns({f"z_{f}": F.round(score(f)).cast("long") for f in features}).drop(*[f"_{k}_{f}" for f in features for k in "md"])


def _half(x: Column, by: float) -> Column:
    return F.round(x / F.lit(by)).cast("long")


def derived(rows: DataFrame) -> DataFrame:
    """Scored rows with changes against the row before, focus scores, tension, and rolling means of the
    rows before and this one. Weights and caps are fixed values."""
    z = lambda f: F.col(f"z_{f}")
    one = F.lit(MILLION)
    tension = _half(one - z("chord_confidence") + F.col("chord_change") * MILLION, 2.0)
    out = rows.withColumns(
        {
            "energy_delta": windows.delta("z_energy_score"),
            "density_delta": windows.delta("z_density"),
            "vocal_stem_delta": windows.delta("z_vocals_stem"),
            "vocal_focus": F.least(one, _half(z("vocal_presence") * 55 + z("vocals_stem") * 45, 100.0)),
            "percussion_focus": F.greatest(F.lit(0), z("drums_stem") - F.greatest(z("vocals_stem"), z("harmonic_stem"))),
            "instrumental_focus": F.greatest(F.lit(0).cast("long"), _half(z("harmonic_stem") * 60 + z("bass_stem") * 40 - z("vocals_stem") * 50, 100.0)),
            "tension": F.least(one, F.greatest(F.lit(0).cast("long"), tension)),
        }
    )
    return windows.trailing_means(out, {f"{x.removeprefix('z_')}_{name}": (x, size) for name, size in ROLLING.items() for x in ROLLED})
