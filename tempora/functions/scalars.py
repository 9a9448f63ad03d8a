"""Scalar functions of the timeline model, as column expressions (all JVM-side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

#: Note names by pitch class. Fixed values.
PITCH_CLASSES = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def min_max(x: Column, *by: str) -> Column:
    """Scaled to 0..1 within the group; 0 where the range is below 1e-8."""
    w = Window.partitionBy(*by)
    low, high = F.min(x).over(w), F.max(x).over(w)
    return F.when(high - low < 1e-8, F.lit(0.0)).otherwise((x - low) / (high - low))


def max_scale(x: Column, *by: str) -> Column:
    """Divided by the group's largest value; 0 where that is at most 1e-12."""
    high = F.max(x).over(Window.partitionBy(*by))
    return F.when(high <= 1e-12, F.lit(0.0)).otherwise(x / high)


def scale_into(x: Column, low: Column, high: Column, floor: float, ceiling: float) -> Column:
    """Scaled from low..high into floor..ceiling; the middle where the range is flat."""
    span = high - low
    return F.when(F.abs(span) < 1e-9, F.lit((floor + ceiling) / 2)).otherwise(F.lit(floor) + (x - low) / span * F.lit(ceiling - floor))


def z_score(x: Column, mean: Column, deviation: Column) -> Column:
    return F.when(deviation < 1e-9, F.lit(0.0)).otherwise((x - mean) / deviation)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if either vector is zero."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def ladder(x: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first step whose bound x reaches, tried in the given order."""
    return F.coalesce(*[F.when(x >= bound, F.lit(label)) for bound, label in steps], F.lit(otherwise))


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length that two intervals share; 0 for those that only touch."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def overlap_ratio(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Shared length over the longer duration; 0 where both are empty."""
    longer = F.greatest(a_end - a_start, b_end - b_start)
    return F.when(longer <= 0, F.lit(0.0)).otherwise(overlap(a_start, a_end, b_start, b_end) / longer)


def canonical_label(x: Column) -> Column:
    """Trimmed, lower-cased, dashes as blanks, runs of blanks as one underscore."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(F.trim(x)), "-", " ")), r"\s+", "_")


def normal_chord(x: Column) -> Column:
    """A chord name's root and minor mark: sharps and flats kept, ``min`` as ``m``, the rest of the
    quality dropped; N for none."""
    root = F.regexp_extract(F.trim(x), r"^([A-Ga-g][#b]?)", 1)
    minor = F.regexp_extract(F.trim(x), r"^[A-Ga-g][#b]?(m(?!aj)|min|-)", 1)
    return F.when(x.isNull() | (root == ""), F.lit("N")).otherwise(F.concat(F.upper(F.substring(root, 1, 1)), F.substring(root, 2, 1), F.when(minor != "", F.lit("m")).otherwise(F.lit(""))))


def note_name(pitch: Column) -> Column:
    return F.concat(F.element_at(F.array(*[F.lit(p) for p in PITCH_CLASSES]), F.pmod(pitch, F.lit(12)) + 1), (F.floor(pitch / 12) - 1).cast("string"))


def clock(seconds: Column) -> Column:
    """m:ss.s"""
    tenths = F.floor(seconds * 10 + 0.5).cast("long")
    return F.format_string("%d:%02d.%d", F.floor(tenths / 600).cast("long"), (F.floor(tenths / 10) % 60).cast("long"), tenths % 10)


def keyword_labels(text: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Labels of the rules of which any keyword stands in the lower-cased text, in rule order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hit = [F.when(reduce(lambda a, b: a | b, [low.contains(k) for k in words]), F.lit(label)) for label, words in rules]
    return F.array_compact(F.array(*hit))


def html_escape(x: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(raw), F.lit(safe))
    return x


def timing_direction(delta: Column, tolerance: float) -> Column:
    return F.when(F.abs(delta) <= tolerance, F.lit("aligned")).when(delta < 0, F.lit("early")).otherwise(F.lit("late"))


def title_parts(name: Column) -> tuple[Column, Column]:
    """Title and artist of ``title - artist``, split at the first dash."""
    parts = F.split(name, " - ", 2)
    return F.element_at(parts, 1), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
