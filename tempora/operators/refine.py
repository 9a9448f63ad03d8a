"""Refinement of rule candidates, and events guided by phrases, lyric lines and hints.

Every rule here looks at means of feature rows within a window. Windows of all kinds meet the rows once, by a
range join on time buckets, and the means are whole millionths from exact sums.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import joins
from .rule_events import HALF_UP, clamped, share
from .rules import pick_variant
from .windows import ENTITY

#: Least mean rise that turns a breakdown or pause into an energy reset. Fixed values, as are all weights below.
RESET_RISE = 0.18
#: Words that make a hint one about percussion, or about an ending.
PERCUSSION_WORDS = ["snare", "ride", "drum", "percussion"]
ENDING_WORDS = ["ends slowly", "ends", "tail", "fade", "fades out"]


def window_means(spans: DataFrame, rows: DataFrame, means: dict[str, Column], width: int, key: str, prefix: str = "", start: str = "start_t", end: str = "end_t") -> DataFrame:
    """spans with <prefix>n, the number of rows that share time with each span, and the mean of each
    expression over them as a share of one (0 where no row does); and <prefix>last_t, the last row's end."""
    a = spans.select(ENTITY, key, F.col(start).alias("a_start"), F.col(end).alias("a_end"))
    b = rows.select(ENTITY, F.col("t").alias("b_start"), F.col("end_t").alias("b_end"), *[c.alias(f"_x_{n}") for n, c in means.items()])
    met = joins.overlapping(a, b, width)
    out = met.groupBy(ENTITY, key).agg(
        F.count("*").alias(f"{prefix}n"), F.max("b_end").alias(f"{prefix}last_t"), *[share(F.round(F.sum(f"_x_{n}") / F.count("*"))).alias(f"{prefix}{n}") for n in means]
    )
    return spans.join(out, [ENTITY, key], "left").fillna(0, [f"{prefix}n"]).fillna(0.0, [f"{prefix}{n}" for n in means])


#: What each variant's candidate says, and what an event says that takes none. Fixed values.
VARIANT_NOTES = {
    "drop_explode": "Explosive release with strong accent and spectral opening.",
    "drop_groove": "Sustained bass-led release with groove continuity.",
    "drop_punch": "Compact high-impact release with punch-forward attack.",
    "soft_release": "Release resolves tension with softer attack and less explosive accent.",
    "groove_loop": "Stable bass-led pulse and sustained motion support a groove-loop interpretation.",
    "atmospheric_plateau": "Lower-volatility texture and sustained space support an atmospheric plateau.",
    "no_drop_plateau": "Build evidence remains present, but sustained-state evidence is not decisive enough for a narrower subtype.",
}
KEEPS_DROP = "Subtype evidence is not decisive enough; keeping parent drop label."
KEEPS_PLATEAU = "Sustained-state subtype evidence is not decisive enough; keeping the parent plateau label."
RESETS = "Follow-up energy rise indicates a reset-and-reentry mechanic."
RESET_NOTES = ("Energy rebuild follows the negative-space window.", "Parent transition remains a valid fallback.")
#: Rise of the spectral centroid that counts as wholly open.
OPEN_CENTROID = 200.0


def ranked_candidates(scores: dict[str, Column]) -> Column:
    """Scores as candidates (type, confidence, notes), the best first, equals in their order."""
    listed = F.array(*[F.struct((-score).alias("down"), F.lit(i).alias("place"), F.lit(name).alias("type"), score.alias("confidence"), F.lit(VARIANT_NOTES[name]).alias("notes")) for i, (name, score) in enumerate(scores.items())])
    return F.transform(F.array_sort(listed), lambda s: F.struct(s["type"].alias("type"), s["confidence"].alias("confidence"), s["notes"].alias("notes")))


def refine_candidates(events: DataFrame, rows: DataFrame, width: int, after: int, seconds: int = 1_000_000, key: str = "event_key", identifiers: DataFrame | None = None) -> DataFrame:
    """events (entity_id, key, type, start_t, end_t, confidence, section_character, perhaps intensity) with ``refined``, the type
    after refinement: drops and plateaus take the variant of the clearly best score; a breakdown or pause that is
    followed within ``after`` by a mean rise becomes an energy reset. ``refined_confidence`` follows, ``refined_intensity`` (the
    event's own, else from its window), ``candidates`` with what speaks for each, null where nothing was weighed, and ``note``.
    identifiers (entity_id, key, spectral_centroid_delta), one row an event at most, say how far a drop's spectrum opens."""
    c = F.col
    if identifiers is not None:
        opens = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("spectral_centroid_delta") / OPEN_CENTROID))
        told = identifiers.select(ENTITY, key, opens.alias("spectral_rise"), F.lit(True).alias("identified"))
        events = events.join(told, [ENTITY, key], "left").fillna(0.0, ["spectral_rise"]).fillna(False, ["identified"])
    else:
        events = events.withColumns({"spectral_rise": F.lit(0.0), "identified": F.lit(False)})
    means = {"delta": c("energy_delta"), "accent": c("z_accent_intensity"), "bass": c("z_bass_activation"), "energy": c("energy_score_local"), "onset": c("z_onset"), "vocal": c("z_vocal_presence"), "score": c("z_energy_score")}
    held = window_means(events, rows, means, width, key)
    later = held.withColumns({"_from": c("end_t"), "_to": c("end_t") + after})
    followed = window_means(later, rows, {"rise": F.greatest(F.lit(0), c("energy_delta"))}, width, key, "next_", "_from", "_to").drop("_from", "_to")
    one = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    above = lambda x: F.greatest(F.lit(0.0), x)
    opening = c("spectral_rise")
    drops = {
        "drop_explode": c("accent") * 0.4 + one(c("delta") * 2.0) * 0.25 + opening * 0.2 + c("onset") * 0.15,
        "drop_groove": c("bass") * 0.4 + c("energy") * 0.3 + c("onset") * 0.2 + above(1.0 - c("accent")) * 0.1,
        "drop_punch": c("accent") * 0.5 + one(c("delta") * 2.0) * 0.3 + above(1.0 - c("energy")) * 0.2,
        "soft_release": above(0.75 - c("accent")) * 0.4 + c("energy") * 0.35 + above(0.55 - c("onset")) * 0.25,
    }
    length = (c("end_t") - c("start_t")) / F.lit(float(seconds))
    named = lambda *words: F.when(reduce(lambda a, b: a | b, [c("section_character").contains(w) for w in words]), 1.0).otherwise(0.0)
    plateaus = {
        "groove_loop": c("bass") * 0.3 + c("score") * 0.25 + c("onset") * 0.2 + F.least(F.lit(1.0), length / 16.0) * 0.15 + named("groove") * 0.1,
        "atmospheric_plateau": above(0.6 - c("onset")) * 0.32 + above(0.55 - c("bass")) * 0.22 + above(0.5 - c("score")) * 0.18 + F.least(F.lit(1.0), length / 16.0) * 0.18 + named("ambient", "breath") * 0.1,
        "no_drop_plateau": F.least(F.lit(1.0), length / 12.0) * 0.2 + c("score") * 0.15 + 0.3,
    }
    drops, plateaus = ({n: F.round(one(s) + HALF_UP, 6) for n, s in of.items()} for of in (drops, plateaus))
    scored = pick_variant(followed, drops, 0.62, 0.05).withColumnsRenamed({"variant": "_drop", "top_score": "_drop_top"})
    scored = pick_variant(scored, plateaus, 0.55, 0.04).withColumnsRenamed({"variant": "_plateau", "top_score": "_plateau_top"})
    kind, rise, sure = c("type"), c("next_rise"), c("confidence")
    reset = kind.isin("breakdown", "pause_break") & (rise >= RESET_RISE)
    refined = F.when(kind == "drop", F.coalesce("_drop", kind)).when(kind == "no_drop_plateau", F.coalesce("_plateau", kind)).when(reset, "energy_reset").otherwise(kind)
    moved = (
        F.when((kind == "drop") & (c("n") > 0), F.least(F.lit(1.0), sure + (c("_drop_top") - 0.5) * 0.15))
        .when((kind == "no_drop_plateau") & (c("n") > 0), F.least(F.lit(1.0), F.greatest(sure, c("_plateau_top") * 0.9)))
        .when(reset, F.least(F.lit(1.0), F.greatest(sure, rise * 0.5 + 0.55)))
        .otherwise(sure)
    )
    weighed = c("n") > 0
    candidate = lambda name, confidence, notes: F.struct(name.alias("type"), confidence.alias("confidence"), F.lit(notes).alias("notes"))
    resets = F.array(candidate(F.lit("energy_reset"), clamped(rise + 0.55), RESET_NOTES[0]), candidate(kind, sure, RESET_NOTES[1]))
    candidates = F.when((kind == "drop") & weighed, ranked_candidates(drops)).when((kind == "no_drop_plateau") & weighed, ranked_candidates(plateaus)).when(reset, resets)
    taken = F.create_map(*[F.lit(x) for pair in VARIANT_NOTES.items() for x in pair])
    keeps = c("_plateau").isNull() | (c("_plateau") == "no_drop_plateau")
    note = (
        F.when((kind == "drop") & weighed, F.coalesce(F.try_element_at(taken, c("_drop")), F.lit(KEEPS_DROP)))
        .when((kind == "no_drop_plateau") & weighed, F.when(keeps, KEEPS_PLATEAU).otherwise(F.try_element_at(taken, c("_plateau"))))
        .when(reset, RESETS)
    )
    given = c("intensity") if "intensity" in events.columns else F.lit(None).cast("double")
    return scored.withColumns(
        {
            "refined": F.when(weighed | ~kind.isin("drop", "no_drop_plateau"), refined).otherwise(kind),
            "refined_confidence": F.round(moved + HALF_UP, 6),
            "refined_intensity": intensity_of(given, c("accent"), c("score"), c("bass"), c("n"), sure),
            "candidates": candidates,
            "note": note,
        }
    )


def intensity_of(given: Column, accent: Column, energy: Column, bass: Column, n: Column, confidence: Column) -> Column:
    """The given intensity, else the largest of the window's means and the confidence, else the confidence."""
    return clamped(F.coalesce(given, F.when(n > 0, F.greatest(accent, energy, bass, confidence)), confidence))


def _listed(found: DataFrame, cases: list[tuple[str, Column, Column, Column, Column, Column]], *keep: str) -> DataFrame:
    """A row for each case (type, when, start, end, confidence, intensity) that holds."""
    table = F.array_compact(F.array(*[F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(kind).alias("type"), start.alias("start_t"), end.alias("end_t"), clamped(sure).alias("confidence"), clamped(strength).alias("intensity"))) for kind, when, start, end, sure, strength in cases]))
    return found.select(ENTITY, *keep, F.explode(table).alias("_e")).select(ENTITY, *keep, "_e.*")


def phrase_events(phrases: DataFrame, rows: DataFrame, width: int, entry: int = 4_000_000) -> DataFrame:
    """Hook phrases (a group of two phrases or more, with vocals) and anthem calls (strong vocals and energy at a
    section's start) of phrases (phrase, phrase_group, start_t, end_t, section_start)."""
    c = F.col
    counted = phrases.groupBy(ENTITY, "phrase_group").agg(F.count("*").alias("repeats"))
    found = window_means(phrases.join(counted, [ENTITY, "phrase_group"], "left"), rows, {"vocal": c("z_vocal_presence"), "energy": c("energy_score_local")}, width, "phrase").where("n > 0")
    vocal, energy = c("vocal"), c("energy")
    sure, strength = vocal * 0.35 + energy * 0.2 + 0.4, F.greatest(vocal, energy)
    near = c("start_t") - F.coalesce("section_start", "start_t") <= entry
    return _listed(found, [("hook_phrase", (F.coalesce("repeats", F.lit(1)) >= 2) & (vocal >= 0.35), c("start_t"), c("end_t"), sure, strength), ("anthem_call", (vocal >= 0.5) & (energy >= 0.45) & near, c("start_t"), c("end_t"), sure, strength)], "phrase")


def lyric_events(lines: DataFrame, rows: DataFrame, existing: DataFrame, width: int, after: int = 2_500_000) -> DataFrame:
    """Vocal spotlights over lyric lines (line, start_t, end_t, line_confidence) with leading vocals, and vocal
    tails where the vocals fall off within ``after``. Windows that an event of the same type has are left out."""
    c = F.col
    stems = {"vocals": c("z_vocals_stem"), "focus": c("vocal_focus"), "drums": c("z_drums_stem"), "bed": c("instrumental_focus")}
    held = window_means(lines, rows, stems, width, "line").where("n > 0").withColumns({"_from": c("end_t"), "_to": c("end_t") + after})
    found = window_means(held, rows, {"vocals": c("z_vocals_stem"), "harmonic": c("z_harmonic_stem"), "drums": c("z_drums_stem")}, width, "line", "next_", "_from", "_to")
    fall, own = c("vocals") - c("next_vocals"), c("line_confidence")
    cases = [
        ("vocal_spotlight", (c("vocals") >= 0.32) & (c("focus") >= 0.32) & ((c("vocals") >= c("drums")) | (own >= 0.7)), c("start_t"), c("end_t"), c("focus") * 0.35 + c("vocals") * 0.2 + F.least(F.lit(0.12), own * 0.12) + 0.42, F.greatest("vocals", "focus")),
        ("vocal_tail", (c("next_n") > 0) & (c("focus") >= 0.34) & (fall >= 0.18) & (F.greatest("next_harmonic", "next_drums", "bed") >= 0.12), c("end_t"), c("next_last_t"), fall * 0.55 + F.least(F.lit(0.1), own * 0.1) + 0.42, fall),
    ]
    return _new(_listed(found, cases, "line"), existing)


def hint_events(hints: DataFrame, rows: DataFrame, existing: DataFrame, width: int, before: int = 2_000_000) -> DataFrame:
    """Percussion breaks and vocal tails where a hint (hint, start_t, end_t, text) names one and the stems bear it
    out; hints without a length are left out."""
    c = F.col
    stems = {"drums": c("z_drums_stem"), "vocals": c("z_vocals_stem"), "harmonic": c("z_harmonic_stem"), "percussion": c("percussion_focus"), "bed": c("instrumental_focus")}
    held = window_means(hints.where("end_t > start_t"), rows, stems, width, "hint").where("n > 0").withColumns({"_from": F.greatest(F.lit(0), c("start_t") - before), "_to": c("start_t")})
    found = window_means(held, rows, {"focus": c("vocal_focus")}, width, "hint", "before_", "_from", "_to")
    low = F.lower("text")
    says = lambda words: reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    fall = c("before_focus") - c("vocals")
    cases = [
        ("percussion_break", says(PERCUSSION_WORDS) & (c("drums") >= 0.28) & (c("percussion") >= 0.08) & (c("vocals") <= 0.3), c("start_t"), c("end_t"), c("drums") * 0.25 + c("percussion") * 0.6 + 0.45, F.greatest("drums", "percussion")),
        ("vocal_tail", says(ENDING_WORDS) & (c("before_focus") >= 0.35) & (fall >= 0.12) & (F.greatest("harmonic", "bed", "drums") >= 0.12), c("start_t"), c("end_t"), fall * 0.8 + 0.45, fall),
    ]
    return _new(_listed(found, cases, "hint"), existing)


def _new(events: DataFrame, existing: DataFrame) -> DataFrame:
    known = existing.select(ENTITY, "start_t", "end_t", "type").distinct()
    return events.join(known, [ENTITY, "start_t", "end_t", "type"], "left_anti")
