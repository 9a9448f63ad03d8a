"""Operators that bring tracks of notes, frames, drums and phrases onto a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import in_range, nearest
from .windows import ENTITY


def frames_on_beats(frames: DataFrame, beats: DataFrame, width: int, value: str) -> DataFrame:
    """Mean of the frame values in [start_t, end_t) of each beat; of a beat without frames, the value
    of the frame nearest its start. beats: entity_id, beat_id, start_t, end_t; frames: entity_id, t."""
    inside = in_range(frames.select(ENTITY, "t", value), beats, width).groupBy(ENTITY, "beat_id").agg((F.sum(value) / F.count(value)).alias("_mean"))
    near = nearest(beats, frames.select(ENTITY, "t", F.col(value).alias("_near")), time="start_t")
    return near.join(inside, [ENTITY, "beat_id"], "left").select(ENTITY, "beat_id", F.coalesce("_mean", F.col("near._near").cast("double")).alias("mean"), F.col("_mean").isNull().alias("from_nearest"))


def envelope(rows: DataFrame, block: int, value: str) -> DataFrame:
    """Least and largest value of each run of ``block`` rows."""
    return rows.groupBy(ENTITY, F.floor((F.col("idx") - 1) / block).alias("block")).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def bucket_vector_max(vectors: DataFrame, by: Column, vector: str) -> DataFrame:
    """Largest component at each place over the vectors of a bucket: bucket, place, largest."""
    return vectors.select(by.alias("bucket"), F.posexplode(vector).alias("place", "x")).groupBy("bucket", "place").agg(F.max("x").alias("largest"))


def note_cards(notes: DataFrame, by: list[str], pitch: str, low: int = 48, long: int | None = None, duration: str | None = None) -> DataFrame:
    """For each group: notes, pitch range, mean pitch of those from ``low`` up, and the share of notes of
    at least ``long``."""
    high = F.when(F.col(pitch) >= low, F.col(pitch))
    more = [(F.count_if(F.col(duration) >= long) / F.count("*")).alias("sustained")] if duration else []
    return notes.groupBy(ENTITY, *by).agg(F.count("*").alias("n"), (F.max(pitch) - F.min(pitch)).alias("pitch_range"), (F.sum(high) / F.count(high)).alias("centroid"), *more)


def motion(notes: DataFrame, pitch: str) -> DataFrame:
    """Share of repeated pitches among successive notes, and the median absolute interval."""
    step = F.abs(F.col(pitch) - F.lag(pitch).over(Window.partitionBy(ENTITY).orderBy("idx")))
    return notes.withColumn("_s", step).where("_s is not null").groupBy(ENTITY).agg((F.count_if(F.col("_s") == 0) / F.count("*")).alias("repeated"), F.median("_s").alias("median_interval"))


def kind_summary(hits: DataFrame, kind: str, kinds: list[str], least: dict[str, int]) -> DataFrame:
    """Counts of each kind, and flags: ``missing_x`` for a kind below its least count."""
    counts = hits.groupBy(ENTITY).agg(*[F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds])
    flags = F.array_compact(F.array(*[F.when(F.col(f"n_{k}") < n, F.lit(f"missing_{k}")) for k, n in least.items()]))
    return counts.withColumn("flags", F.array_join(flags, ","))


def call_and_response(phrases: DataFrame, section: str, group: str, start: str = "start_t", key: str = "event_id") -> DataFrame:
    """Pairs of adjacent phrases of one section and different groups: first and second key."""
    w = Window.partitionBy(ENTITY).orderBy(start, key)
    after = phrases.withColumns({"_k": F.lead(key).over(w), "_s": F.lead(section).over(w), "_g": F.lead(group).over(w)})
    return after.where((F.col("_s") == F.col(section)) & (F.col("_g") != F.col(group))).select(ENTITY, F.col(key).alias("call_id"), F.col("_k").alias("response_id"))


def tails(phrases: DataFrame, rows: DataFrame, value: str, within: int, drop: int) -> DataFrame:
    """Phrases (event_id, start_t, end_t) after which the mean value within the time falls by at least
    ``drop`` below the mean inside: phrase, inside and after means."""
    own = phrases.select(ENTITY, F.col("event_id").alias("phrase_id"), "start_t", "end_t")
    points = rows.select(ENTITY, "t", value)
    inside = in_range(points, own, within).groupBy(ENTITY, "phrase_id").agg((F.sum(value) / F.count(value)).alias("inside_mean"))
    behind = own.select(ENTITY, "phrase_id", F.col("end_t").alias("start_t"), (F.col("end_t") + within).alias("end_t"))
    after = in_range(points, behind, within).groupBy(ENTITY, "phrase_id").agg((F.sum(value) / F.count(value)).alias("after_mean"))
    return inside.join(after, [ENTITY, "phrase_id"]).where(F.col("inside_mean") - F.col("after_mean") >= drop)


def lowest_on_beats(notes: DataFrame, beats: DataFrame, pitch: str, rank: Column | None = None) -> DataFrame:
    """Of the notes nearest to each beat the one of least ``rank``, by default the lowest, the first by id on a tie, and the least pitch: beat_id, note, pitch."""
    placed = nearest(notes, beats.select(ENTITY, "t", "beat_id"))
    first = F.struct((F.col(pitch) if rank is None else rank).alias("rank"), F.col(pitch), "event_id")
    return placed.where("near is not null").groupBy(ENTITY, F.col("near.beat_id").alias("beat_id")).agg(F.min_by("event_id", first).alias("event_id"), F.min(pitch).alias("lowest"))


def repetition(windows: DataFrame, section: str, group: str) -> DataFrame:
    """For each section: windows in groups that occur at least twice in the entity, over the largest
    such count of its sections; 0 where none repeats."""
    often = windows.withColumn("_n", F.count("*").over(Window.partitionBy(ENTITY, group)))
    counts = often.groupBy(ENTITY, section).agg(F.count_if(F.col("_n") >= 2).alias("repeated"))
    most = F.max("repeated").over(Window.partitionBy(ENTITY))
    return counts.withColumn("score", F.when(most == 0, F.lit(0.0)).otherwise(F.col("repeated") / most))


def sequence_at(windows: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Windows (window_id, first, labels) that lie in an occurrence (first, labels) of the entity and
    equal its labels there: window_id, occurrence_id."""
    inner = windows.select(ENTITY, "window_id", F.col("first").alias("_first"), F.col("labels").alias("_labels"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("_k"))
    keyed = inner.withColumn("_block", F.floor(F.col("_first") / 4) - F.col("_k"))
    outer = occurrences.withColumn("_block", F.floor(F.col("first") / 4))
    at = F.col("_first") - F.col("first")
    fits = (at >= 0) & (at + F.size("_labels") <= F.size("labels"))
    return keyed.join(outer, [ENTITY, "_block"]).where(fits & (F.slice("labels", at + 1, F.size("_labels")) == F.col("_labels"))).select(ENTITY, "window_id", "occurrence_id")


def multiples(deltas: DataFrame, delta: str, unit: int) -> DataFrame:
    """How often each rounded multiple of a unit occurs among the deltas: multiple, n, share."""
    counts = deltas.groupBy(ENTITY, F.floor((F.col(delta) + unit / 2) / unit).alias("multiple")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(ENTITY)))


def transitions(cards: DataFrame, value: str, rise: float, order: str = "section") -> DataFrame:
    """Role of each section by its value against the neighbours': opening, lift, fall, closing or steady."""
    w = Window.partitionBy(ENTITY).orderBy(order)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    role = F.when(before.isNull(), "opening").when(after.isNull(), "closing").when(F.col(value) - before >= rise, "lift").when(before - F.col(value) >= rise, "fall").otherwise("steady")
    return cards.withColumn("role", role)
