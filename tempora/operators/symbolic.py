"""The symbolic layer: from notes of several sources to the notes that count, and cards of beats, bars, sections and songs.

Sources are judged for each entity by counts over their aligned notes and promoted or not; promoted notes are thinned, and all cards
are group-bys over range joins of those notes with beats and bars. Times are microseconds, confidences whole millionths, and centroids
are summed as such, so every threshold is held against exact numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ladder
from . import cards, joins, sequences
from .beat_features import MILLION
from .windows import ENTITY

#: Order in which a source's note stands before another's, and how far from a beat its notes may lie, in microseconds. Fixed values.
PRIORITY = {"bass": 0, "harmonic": 1, "vocals": 2, "full_mix": 3, "drums": 4}
TOLERANCE = {"harmonic": 300_000, "bass": 200_000, "vocals": 300_000, "drums": 200_000, "full_mix": 200_000}
#: Notes closer than this in time, and no farther apart than a semitone, are one. Fixed value.
SAME_WITHIN = 75_000
#: What decides whether a source is promoted. Fixed values.
LOW, HIGH, LOW_SHARE, RESOLVED_SHARE, HIGH_SHARE, VOCAL_CONFIDENCE, MIX_CONFIDENCE = 55, 60, 0.45, 0.2, 0.5, 0.35, 0.3
REASONS = {
    "bass": ("bass source passed low-register validation", "bass source did not sustain enough low-register notes"),
    "harmonic": ("harmonic source provides core note texture", "harmonic source alignment coverage was too low"),
    "vocals": ("vocal melody notes passed confidence and register checks", "vocal source kept as auxiliary only"),
    "full_mix": ("full-mix source complements missing notes from stems", "full-mix source retained only as raw cache"),
}
PERCUSSIVE = "percussive source analyzed for review but not promoted to the final melodic note stream by default"
#: Words for a register, from the least mean pitch up, and the pitch from which a note counts for it. Fixed values.
REGISTERS, REGISTER_FROM = [(84.0, "very-high"), (72.0, "high"), (60.0, "mid"), (48.0, "low-mid")], 48
LONG_NOTE = 500_000


@dataclass
class SymbolicLayer:
    """quality: a row for each source; notes: those that count; and the cards."""

    quality: DataFrame
    notes: DataFrame
    beats: DataFrame
    bars: DataFrame
    sections: DataFrame
    songs: DataFrame


def register(centroid: Column) -> Column:
    return F.when(centroid.isNull(), "unknown").otherwise(ladder(centroid, REGISTERS, "low"))


def source_quality(notes: DataFrame) -> DataFrame:
    """A row for each entity and source of aligned notes (source, pitch, length, confidence in millionths, resolved): counts, shares, means, medians and
    ranges, whether it is promoted, the decision and its reason."""
    n = F.count("*")
    share = lambda when: F.count_if(when) / n
    c = F.col
    found = notes.groupBy(ENTITY, "source").agg(
        n.alias("note_count"), share(c("resolved")).alias("_resolved"), (F.sum("confidence") / n / MILLION).alias("_confidence"), (F.median("confidence") / MILLION).alias("_middle"), F.min("pitch").alias("pitch_min"), F.max("pitch").alias("pitch_max"),
        (F.median("length") / MILLION).alias("_length"), share(c("pitch") <= LOW).alias("_low"), share(c("pitch") >= HIGH).alias("_high"),
    )
    tests = {"bass": c("_low") >= LOW_SHARE, "harmonic": c("_resolved") >= RESOLVED_SHARE, "vocals": (c("_confidence") >= VOCAL_CONFIDENCE) & (c("_high") >= HIGH_SHARE), "full_mix": c("_confidence") >= MIX_CONFIDENCE}
    promoted = F.coalesce(*[F.when(c("source") == s, test) for s, test in tests.items()], F.lit(False))
    refused = F.when(c("source").isin("bass", "harmonic"), "rejected").otherwise("auxiliary_only")
    reason = F.coalesce(*[F.when(c("source") == s, F.when(c("promoted"), good).otherwise(bad)) for s, (good, bad) in REASONS.items()], F.lit(PERCUSSIVE))
    judged = found.withColumn("promoted", promoted)
    six = {"alignment_resolved_ratio": "_resolved", "confidence_mean": "_confidence", "confidence_median": "_middle", "median_duration": "_length", "low_register_ratio": "_low", "mid_high_ratio": "_high"}
    return judged.select(ENTITY, "source", "note_count", *[F.round(x, 6).alias(name) for name, x in six.items()], "pitch_min", "pitch_max", "promoted", F.when(c("promoted"), "promoted").otherwise(refused).alias("decision"), reason.alias("reason"))


def aligned_by_source(notes: DataFrame, beats: DataFrame, bars: DataFrame, sections: DataFrame, tolerance: dict[str, int] = TOLERANCE) -> DataFrame:
    """notes aligned to beats, bars and sections, each within the tolerance of its source."""
    widest = max(tolerance.values())
    placed = cards.aligned_notes(notes, beats, bars, sections, widest)
    own = F.coalesce(*[F.when(F.col("source") == s, F.lit(t)) for s, t in tolerance.items()], F.lit(min(tolerance.values())))
    near = F.col("resolved") & (F.abs("beat_delta") <= own)
    inside = joins.containing(placed, bars.select(ENTITY, F.col("bar").alias("_bar"), "start_t", "end_t"))
    return inside.withColumns({"aligned_bar": F.when(near, F.col("aligned_bar")).otherwise(F.col("inside._bar")), "aligned_idx": F.when(near, F.col("aligned_idx")), "resolved": near}).drop("inside")


def promoted_notes(notes: DataFrame, quality: DataFrame, within: int | None = SAME_WITHIN) -> DataFrame:
    """Notes of promoted sources; near repeats among them thinned, unless ``within`` is None."""
    kept = notes.join(quality.where("promoted").select(ENTITY, "source"), [ENTITY, "source"], "left_semi")
    ranked = kept.withColumn("priority", F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair]), F.col("source")), F.lit(99)))
    return ranked if within is None else sequences.distinct_notes(ranked, within)


def _window_notes(windows_: DataFrame, notes: DataFrame, key: str, width: int) -> DataFrame:
    """Pairs of windows (key, start_t, end_t) and the notes that sound in them."""
    a = windows_.select(ENTITY, key, F.col("start_t").alias("a_start"), F.col("end_t").alias("a_end"))
    return joins.overlapping(a, notes.select(ENTITY, "pitch", F.col("t").alias("b_start"), (F.col("t") + F.col("length")).alias("b_end")), width)


def beat_density(beats: DataFrame, notes: DataFrame, width: int) -> DataFrame:
    """(entity_id, idx, note_count, density): notes that sound in each beat (idx, start_t, end_t), and that by the second."""
    found = _window_notes(beats, notes, "idx", width).groupBy(ENTITY, "idx").agg(F.count("*").alias("note_count"))
    seconds = F.greatest(F.col("end_t") - F.col("start_t"), F.lit(1)) / MILLION
    return beats.join(found, [ENTITY, "idx"], "left").fillna(0, ["note_count"]).select(ENTITY, "idx", "note_count", F.round(F.col("note_count") / seconds, 6).alias("density"))


def bar_cards(bars: DataFrame, notes: DataFrame, width: int) -> DataFrame:
    """Cards of bars (bar, start_t, end_t): notes, density by the beat, most notes at once at start, middle or end, pitch range, centroid of
    what is not low, in millionths, and its register."""
    c = F.col
    met = _window_notes(bars, notes, "bar", width)
    sounds = lambda at: F.count_if((c("b_start") <= at) & (c("b_end") > at))
    middle = F.floor((c("a_start") + c("a_end")) / 2)
    high = F.when(c("pitch") >= REGISTER_FROM, c("pitch"))
    found = met.groupBy(ENTITY, "bar").agg(F.count("*").alias("note_count"), F.greatest(sounds(c("a_start")), sounds(middle), sounds(c("a_end") - 1)).alias("active_note_peak"), F.min("pitch").alias("pitch_min"), F.max("pitch").alias("pitch_max"), F.round(F.sum(high) * MILLION / F.count(high)).cast("long").alias("centroid"))
    joined = bars.join(found, [ENTITY, "bar"], "left").fillna(0, ["note_count", "active_note_peak"])
    return joined.select(ENTITY, "bar", "start_t", "end_t", "note_count", (c("note_count") / 4.0).alias("density"), "active_note_peak", "pitch_min", "pitch_max", "centroid", register(c("centroid") / MILLION).alias("register_label"))


def section_cards(sections: DataFrame, bars: DataFrame, notes: DataFrame, width: int) -> DataFrame:
    """Cards of sections (section, start_t, end_t) from the bars that share time with them and the notes aligned to those: first and last bar, notes, pitch range, mean
    pitch of what is not bass (of all, where all is bass), register, texture, contour of the bars' centroids, density and share of long notes."""
    c = F.col
    a = sections.select(ENTITY, "section", c("start_t").alias("a_start"), c("end_t").alias("a_end"))
    inside = joins.overlapping(a, bars.select(ENTITY, "bar", "note_count", "active_note_peak", "centroid", c("start_t").alias("b_start"), c("end_t").alias("b_end")), width).select(ENTITY, "section", "bar", "note_count", "active_note_peak", "centroid")
    w = Window.partitionBy(ENTITY, "section")
    told = inside.where("centroid is not null").withColumns({"_up": F.row_number().over(w.orderBy("bar")), "_down": F.row_number().over(w.orderBy(F.desc("bar")))})
    third = F.greatest(F.floor((c("_up") + c("_down") - 1) / 3), F.lit(1))
    edge = lambda rank: F.sum(F.when(c(rank) <= third, c("centroid")))
    lines = told.groupBy(ENTITY, "section").agg(F.count("*").alias("_m"), edge("_up").alias("_head"), edge("_down").alias("_tail"), (F.max("centroid") - F.min("centroid")).alias("_spread"))
    drift = (c("_tail") - c("_head")) / F.greatest(F.floor(c("_m") / 3), F.lit(1)) / MILLION
    contour = F.when(F.coalesce("_m", F.lit(0)) < 2, "static").when((F.abs(drift) <= 1.5) & (c("_spread") <= 3 * MILLION), "static").when(drift >= 3.0, "rising").when(drift <= -3.0, "falling").otherwise("undulating")
    whole = inside.groupBy(ENTITY, "section").agg(F.min("bar").alias("bar_start"), F.max("bar").alias("bar_end"), (F.sum("active_note_peak") / F.count("*")).alias("_peak"), (F.sum("note_count") / F.count("*") / 4.0).alias("_density"))
    own = notes.select(ENTITY, "aligned_bar", "source", "pitch", "length").join(inside.select(ENTITY, "section", c("bar").alias("aligned_bar")), [ENTITY, "aligned_bar"])
    melody = F.when(c("source") != "bass", c("pitch"))
    mean = F.coalesce(F.sum(melody) / F.count(melody), F.sum("pitch") / F.count("*"))
    sums = own.groupBy(ENTITY, "section").agg(F.count("*").alias("note_count"), F.min("pitch").alias("pitch_min"), F.max("pitch").alias("pitch_max"), F.round(mean, 6).alias("register_centroid"), F.round(F.count_if(c("length") >= LONG_NOTE) / F.count("*"), 6).alias("sustain_ratio"))
    peak, density = F.coalesce("_peak", F.lit(0.0)), F.coalesce("_density", F.lit(0.0))
    texture = F.when((peak >= 4) | (density >= 3.0), "layered").when((peak >= 2) | (density >= 1.5), "polyphonic").when(density >= 0.7, "melodic").otherwise("sparse")
    joined = sections.join(whole, [ENTITY, "section"], "left").join(lines, [ENTITY, "section"], "left").join(sums, [ENTITY, "section"], "left").fillna(0, ["note_count"]).fillna(0.0, ["sustain_ratio"])
    return joined.select(ENTITY, "section", "bar_start", "bar_end", "note_count", "pitch_min", "pitch_max", "register_centroid", register(c("register_centroid")).alias("register_label"), texture.alias("texture"), contour.alias("melodic_contour"), F.round("_density", 6).alias("density_mean"), "sustain_ratio")


def bass_motion(notes: DataFrame) -> DataFrame:
    """(entity_id, bass_motion): pedal, stepwise, leaping or mixed by the steps between an entity's bass notes; minimal for fewer than two notes."""
    step = F.abs(F.col("pitch") - F.lag("pitch").over(Window.partitionBy(ENTITY).orderBy("t", "event_id")))
    found = notes.where("source = 'bass'").withColumn("_s", step).groupBy(ENTITY).agg(F.count("_s").alias("_n"), F.count_if(F.col("_s") == 0).alias("_zero"), F.median("_s").alias("_middle"))
    label = F.when(F.col("_n") < 1, "minimal").when(F.col("_zero") >= 0.45 * F.col("_n"), "pedal").when(F.col("_middle") <= 2, "stepwise").when(F.col("_middle") >= 5, "leaping").otherwise("mixed")
    return found.select(ENTITY, label.alias("bass_motion"))


def song_cards(notes: DataFrame, sections: DataFrame) -> DataFrame:
    """(entity_id, note_count, pitch_min, pitch_max, texture, density_mean, bass_motion): an entity's notes, its commonest section texture (the first by
    name on a tie) and its sections' mean density. Entities without notes have a card if they have sections."""
    sums = notes.groupBy(ENTITY).agg(F.count("*").alias("note_count"), F.min("pitch").alias("pitch_min"), F.max("pitch").alias("pitch_max"))
    often = sections.groupBy(ENTITY, "texture").agg(F.count("*").alias("n"), F.sum(F.round(F.col("density_mean") * MILLION).cast("long")).alias("d"), F.count("density_mean").alias("m"))
    whole = often.groupBy(ENTITY).agg(F.min_by("texture", F.struct(-F.col("n"), F.col("texture"))).alias("texture"), F.round(F.sum("d") / F.sum("m") / MILLION, 6).alias("density_mean"))
    joined = whole.join(sums, ENTITY, "full").join(bass_motion(notes), ENTITY, "left").fillna(0, ["note_count"])
    return joined.select(ENTITY, "note_count", "pitch_min", "pitch_max", "texture", "density_mean", F.coalesce("bass_motion", F.lit("minimal")).alias("bass_motion"))


def symbolic_layer(notes: DataFrame, beats: DataFrame, bars: DataFrame, sections: DataFrame, width: int, tolerance: dict[str, int] = TOLERANCE, within: int | None = SAME_WITHIN, keep=lambda df, name: df) -> SymbolicLayer:
    """The layer of notes (event_id, source, t, length, pitch, confidence), beats (idx, bar, t, end_t), bars (bar, start_t, end_t) and
    sections (section, start_t, end_t). ``width`` is the bucket of the range joins, near a bar's length. ``keep`` may write what several cards read as a
    table. Where no source of an entity is promoted its cards are those of silence."""
    aligned = keep(aligned_by_source(notes, beats, bars, sections.select(ENTITY, "section", "start_t", "end_t"), tolerance), "symbolic-aligned")
    quality = source_quality(aligned)
    final = keep(promoted_notes(aligned, quality, within), "symbolic-notes")
    by_bar = keep(bar_cards(bars, final, width), "symbolic-bars")
    by_section = keep(section_cards(sections, by_bar, final, width), "symbolic-sections")
    spans = beats.select(ENTITY, "idx", F.col("t").alias("start_t"), "end_t")
    return SymbolicLayer(quality, final, beat_density(spans, final, width), by_bar, by_section, song_cards(final, by_section))
