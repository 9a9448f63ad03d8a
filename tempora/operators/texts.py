"""Descriptions in words, and the compact rows that a browser shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PITCH_CLASSES
from . import cards, joins
from .reports import looked_up
from .section_hints import REPETITION, SUSTAIN, worded
from .windows import ENTITY

#: Words for density of songs and sections, and of phrases, from the highest bound down. Fixed values.
DENSITY = [(18.0, "very dense"), (12.0, "dense"), (7.0, "moderately dense"), (3.0, "light")]
PHRASE_DENSITY = [(70.0, "high activity"), (50.0, "active motion"), (30.0, "moderate activity")]


def one_decimal(x: Column) -> Column:
    """x, not negative, with one digit, rounded by its exact binary value, ties to even; n/a for none. (format_string rounds the shortest decimal that
    stands for x, so 16.45, which is a little less, would become 16.5.)"""
    twenty, small = x * 16 + x * 4, x * 4
    rest = small - (twenty - x * 16)  # what the sum lacks to twenty times x, exactly
    low = F.floor(twenty / 2)
    over = twenty - low * 2
    up = F.when(over > 1, True).when(over < 1, False).when(rest != 0, rest > 0).otherwise(low % 2 == 1)
    return F.when(x.isNull(), "n/a").otherwise(F.format_string("%.1f", (low + F.when(up, 1).otherwise(0)) / 10.0))


def capital(text: Column) -> Column:
    """The first letter in upper case, the others in lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1_000_000)))


def _repetition(x: Column) -> Column:
    return worded(x, REPETITION, "limited repetition", "unknown repetition")


def _sustain(x: Column) -> Column:
    return worded(x, SUSTAIN, "clipped note lengths", "unknown sustain")


def _dense(x: Column) -> Column:
    return worded(x, DENSITY, "sparse", "unknown density")


def section_descriptions(sections: DataFrame) -> DataFrame:
    """sections (section_id, section_name or null, bar_start, bar_end, texture, melodic_contour, density_mean, repetition_score, sustain_ratio) with ``description``."""
    c = F.col
    name = capital(F.coalesce("section_name", "section_id"))
    text = F.format_string("%s spans bars %s-%s with a %s texture, %s contour, %s activity (%s notes per bar), %s, and %s.", name, F.coalesce(c("bar_start").cast("string"), F.lit("None")), F.coalesce(c("bar_end").cast("string"), F.lit("None")), "texture", "melodic_contour", _dense(c("density_mean")), one_decimal(c("density_mean")), _repetition(c("repetition_score")), _sustain(c("sustain_ratio")))
    return sections.withColumn("description", text)


def song_descriptions(songs: DataFrame) -> DataFrame:
    """songs (texture, register_label, melodic_contour, density_mean, bass_motion, repetition_score, sustain_ratio) with ``description``."""
    c = F.col
    text = F.format_string("%s %s-register material with %s contour, %s activity (%s notes per bar), %s bass movement, %s, and %s.", capital(c("texture")), "register_label", "melodic_contour", _dense(c("density_mean")), one_decimal(c("density_mean")), "bass_motion", _repetition(c("repetition_score")), _sustain(c("sustain_ratio")))
    return songs.withColumn("description", text)


def phrase_group_descriptions(phrases: DataFrame) -> DataFrame:
    """(entity_id, phrase_group, description) of groups of two phrases or more: phrases (phrase_group, label, place in order, section_name, melodic_contour, density). Its commonest section and
    contour are those seen first of equals. Densities are added in the order of place, as a sum that depends on how rows are dealt out would round either way at a half."""
    running = F.sum("density").over(Window.partitionBy(ENTITY, "phrase_group").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    added = phrases.withColumn("_sum", running)
    whole = added.groupBy(ENTITY, "phrase_group").agg(F.min("label").alias("label"), F.count("*").alias("n"), (F.max_by("_sum", "place") / F.count("*")).alias("density")).where("n >= 2")

    def commonest(x: str) -> DataFrame:
        counted = phrases.groupBy(ENTITY, "phrase_group", x).agg(F.count("*").alias("_n"), F.min("place").alias("_p"))
        return counted.groupBy(ENTITY, "phrase_group").agg(F.max_by(x, F.struct("_n", -F.col("_p"))).alias(f"top_{x}"))

    joined = whole.join(commonest("section_name"), [ENTITY, "phrase_group"]).join(commonest("melodic_contour"), [ENTITY, "phrase_group"])
    active = worded(F.col("density"), PHRASE_DENSITY, "restrained activity", "unknown activity")
    text = F.format_string("%s recurs %d times, usually in %s, with %s contour and %s (%s notes per bar).", "label", "n", "top_section_name", "top_melodic_contour", active, one_decimal(F.col("density")))
    return joined.select(ENTITY, "phrase_group", text.alias("description"))


def beat_rows(beats: DataFrame, bass: DataFrame, chords: DataFrame) -> DataFrame:
    """Compact rows of beats (idx, t, bar, beat_in_bar): time, beat, bar, the name of the lowest bass note (t, pitch) nearest to each, the chord (start_t, chord) that holds
    at it, and whether it is a downbeat."""
    near = joins.nearest(bass.select(ENTITY, "t", "pitch"), beats.select(ENTITY, "t", "idx")).where("near is not null")
    lowest = near.groupBy(ENTITY, F.col("near.idx").alias("idx")).agg(F.min("pitch").alias("_pitch"))
    held = joins.as_of(beats.select(ENTITY, "idx", "t", "bar", "beat_in_bar"), chords.select(ENTITY, "start_t", "chord"), state_time="start_t", fallback_first=True)
    name = F.get(F.array(*[F.lit(p) for p in PITCH_CLASSES]), F.pmod(F.col("_pitch"), F.lit(12)).cast("int"))
    return held.join(lowest, [ENTITY, "idx"], "left").select(ENTITY, "idx", F.round(F.col("t") / 1e6, 6).alias("time"), F.col("beat_in_bar").alias("beat"), "bar", name.alias("bass"), F.col("state.chord").alias("chord"), F.when(F.col("beat_in_bar") == 1, "downbeat").otherwise("beat").alias("type"))


def section_rows(sections: DataFrame, descriptions: dict[str, str]) -> DataFrame:
    """Compact rows of sections (section_id, start_t, end_t, label, confidence): start, end, title and description."""
    return sections.select(ENTITY, F.round(F.col("start_t") / 1e6, 6).alias("start"), F.round(F.col("end_t") / 1e6, 6).alias("end"), cards.section_title(F.col("label"), F.col("section_id"), F.col("confidence")).alias("title"), looked_up(F.coalesce("label", F.lit("")), descriptions, "").alias("description"))


def report_state(report: Column, status: Column) -> Column:
    """What a browser says of a report: missing without one, else its status, or that it is there."""
    return F.when(report.isNull(), "missing").otherwise(F.coalesce(F.when(status != "", status), F.lit("present")))


def stamped(reports: DataFrame) -> DataFrame:
    """reports with ``generated_at``, the time of the run as ISO text in UTC, the same in all rows."""
    return reports.withColumn("generated_at", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
