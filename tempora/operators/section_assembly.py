"""Sections from coarse groups: starts snapped to bars, refined to novelty, anchored to onsets, and kept in order.

A refined start counts only where it lies behind the start chosen for the section before, which may itself be refined or not.
So each section has two possible starts, and which it takes is a function of which the one before took: always
one of them, the same one, or the other one. Sections where it is always one of them cut the chain; between cuts the
choice is the cut's, turned over once for each section that takes the other one. That is a running sum along the
timeline, so nothing is walked row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins, windows
from .windows import ENTITY, order

#: Least strength of an onset that a start is anchored to, and beats around the start in which it is looked for. Fixed values.
ONSET_STRENGTH, ONSET_BEATS = 0.35, 2
#: Weights of energy, repetition and onset in a section's confidence, its base and its bounds. Fixed values.
ENERGY, REPETITION, ONSET, BASE, LEAST, MOST = 0.25, 0.25, 0.15, 0.35, 0.2, 0.99


def novelty(rows: DataFrame, vector: list[str], energy: str = "energy", onset: str = "onset", flux: str = "flux", reach: int = 4, unit: float = 1.0) -> DataFrame:
    """rows with ``contrast``: how unlike the ``reach`` rows before and those from here on are; the distance of their mean
    vectors, three quarters of what their cosine lacks to one, and weighted differences of their mean energy, onset and flux. All columns are
    whole numbers of 1/unit, so that sums are exact. Null within reach of the ends."""
    back, ahead = order().rowsBetween(-reach, -1), order().rowsBetween(0, reach - 1)
    left, right = ([F.sum(c).over(w) for c in vector] for w in (back, ahead))
    dot = lambda a, b: sum((x * y for x, y in zip(a[1:], b[1:])), a[0] * b[0])
    gap = [r - x for x, r in zip(left, right)]
    size = float(reach * unit)
    distance = F.sqrt(dot(gap, gap).cast("double")) / size
    both = dot(left, left).cast("double") * dot(right, right).cast("double")
    cosine = F.when(both > 0, dot(left, right).cast("double") / F.sqrt(both)).otherwise(1.0)
    change = lambda c: F.abs(F.sum(c).over(ahead) - F.sum(c).over(back)) / size
    total = distance + (F.lit(1.0) - cosine) * 0.75 + change(energy) * 0.6 + change(onset) * 0.35 + change(flux) * 0.25
    whole = (F.count(energy).over(back) == reach) & (F.count(energy).over(ahead) == reach)
    return rows.withColumn("contrast", F.when(whole, F.round(total, 9)))


def beat_interval(beats: DataFrame, default: int) -> DataFrame:
    """(entity_id, interval): the upper median of the times between beats, from counts of equal times; the default
    where an entity has one beat."""
    gaps = beats.withColumn("gap", F.lead("t").over(order()) - F.col("t"))
    counted = gaps.groupBy(ENTITY, "gap").agg(F.count("*").alias("n"))
    total = counted.groupBy(ENTITY).agg(F.sum("n").alias("beats"))
    up_to = F.sum("n").over(Window.partitionBy(ENTITY).orderBy("gap"))
    placed = counted.where("gap is not null").withColumn("up_to", up_to).join(total, ENTITY)
    place = F.least(F.floor(F.col("beats") / 2), F.col("beats") - 2)
    middle = placed.where(F.col("up_to") > place).groupBy(ENTITY).agg(F.min("gap").alias("interval"))
    return total.join(middle, ENTITY, "left").select(ENTITY, F.coalesce("interval", F.lit(default)).alias("interval"))


def anchored(starts: DataFrame, peaks: DataFrame, time: str, found: str) -> DataFrame:
    """starts with ``found``, the time of the nearest peak within the column ``reach`` of the named time, or null."""
    near = joins.nearest(starts.where(F.col(time).isNotNull()), peaks, time=time)
    hit = near.withColumn(found, F.when(F.abs("delta") <= F.col("reach"), F.col("near._at"))).select(ENTITY, "idx", found)
    return starts.join(hit, [ENTITY, "idx"], "left")


def monotone_choice(rows: DataFrame, offered: str, first: str, second: str, chosen: str) -> DataFrame:
    """rows with ``chosen``: ``first`` where ``offered`` is there and lies above the value chosen for the row before,
    else ``second``. The first row of an entity takes the second."""
    a, b = F.lag(first).over(order()), F.lag(second).over(order())
    offer = F.col(offered)
    never = offer.isNull() | a.isNull() | (offer <= F.least(a, b))
    always = offer > F.greatest(a, b)
    fixed = F.when(never, 0).when(always, 1)
    turns = F.when(fixed.isNull() & (b < offer), 1).otherwise(0)  # the row before took the second: this takes the first
    marked = rows.withColumns({"_fixed": fixed, "_turns": turns}).withColumn("_turned", F.sum("_turns").over(order()))
    state, since = F.last("_fixed", True).over(order()), F.last(F.when(F.col("_fixed").isNotNull(), F.col("_turned")), True).over(order())
    takes_first = (state + F.col("_turned") - since) % 2 == 1
    return marked.withColumn(chosen, F.when(takes_first, F.col(first)).otherwise(F.col(second))).drop("_fixed", "_turns", "_turned")


def confidence(energy: Column, repetition: Column, onset: Column) -> Column:
    return F.round(F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.lit(BASE) + energy * ENERGY + repetition * REPETITION + onset * ONSET)) + 1e-9, 6)


def assemble(groups: DataFrame, bars: DataFrame, beats: DataFrame, peaks: DataFrame, reference: Column | None = None, penalty: float = 0.12, gain: float = 0.03, interval: int = 500_000) -> DataFrame:
    """Sections (entity_id, idx, section_id, start_t, end_t, label, confidence, onset_anchored) of groups (entity_id, idx from 1, start_t,
    end_t, preserve_start, label, energy, repetition, onset), with bars (start_t), beats (idx, t, contrast) and onset peaks (t, strength).
    Starts snap to the nearest bar; all but the first, unless preserved or ``reference`` holds (timing is given: bars are canonical), move to the
    beat of best contrast near them; then to the nearest strong onset within two beats. The first section starts at 0,
    each ends where the next starts. Entities without bars keep their starts; those without beats are not refined."""
    given = F.lit(False) if reference is None else reference
    snapped = joins.nearest(groups.select(ENTITY, "idx", "start_t", "end_t", "label", (F.col("preserve_start") | given).alias("kept"), confidence(F.col("energy"), F.col("repetition"), F.col("onset")).alias("confidence")), bars.select(ENTITY, F.col("start_t").alias("t")), later=True, time="start_t")
    snapped = snapped.withColumn("snapped", F.coalesce("near._at", "start_t")).drop("near", "delta")
    at_beats = joins.nearest(snapped.where((F.col("idx") > 1) & ~F.col("kept")).select(ENTITY, F.col("idx").alias("section"), "snapped"), beats.select(ENTITY, "t", F.col("idx").alias("beat")), later=True, time="snapped")
    moved = windows.refine(beats, at_beats.select(ENTITY, F.col("near.beat").alias("idx"), "section", "snapped"), penalty=penalty, gain=gain).select(ENTITY, "section", "snapped", F.col("idx").alias("coarse"), F.col("refined_idx").alias("beat"))
    times = moved.join(beats.select(ENTITY, F.col("idx").alias("beat"), "t"), [ENTITY, "beat"]).select(ENTITY, F.col("section").alias("idx"), F.when(F.col("beat") != F.col("coarse"), F.col("t")).otherwise(F.col("snapped")).alias("refined"))
    reach = beat_interval(beats, interval).select(ENTITY, (F.col("interval") * ONSET_BEATS).alias("reach"))
    offered = snapped.join(times, [ENTITY, "idx"], "left").join(reach, ENTITY, "left").fillna(interval * ONSET_BEATS, ["reach"])
    strong = peaks.where(F.col("strength") >= ONSET_STRENGTH).select(ENTITY, "t")
    both = anchored(anchored(offered, strong, "refined", "refined_onset"), strong, "snapped", "snapped_onset")
    later = F.col("idx") > 1
    pair = lambda time: F.struct(F.coalesce(F.when(later, F.col(f"{time}_onset")), F.col(time)).alias("at"), (later & F.col(f"{time}_onset").isNotNull()).alias("onset"))
    both = both.withColumns({"_a": pair("refined"), "_b": pair("snapped")}).withColumns({"_first": F.col("_a.at"), "_second": F.col("_b.at")})
    picked = monotone_choice(both.withColumn("_first", F.coalesce("_first", "_second")), "refined", "_first", "_second", "_at")
    took = F.when(F.col("_at") == F.col("_a.at"), F.col("_a.onset")).otherwise(F.col("_b.onset"))
    started = picked.withColumns({"start": F.when(later, F.col("_at")).otherwise(F.lit(0)), "onset_anchored": later & F.when(F.col("_a.at") == F.col("_b.at"), F.col("_b.onset") | F.col("_a.onset")).otherwise(took)})
    return started.select(
        ENTITY, "idx", F.format_string("section-%03d", "idx").alias("section_id"), F.col("start").alias("start_t"), F.coalesce(F.lead("start").over(order()), F.col("end_t")).alias("end_t"), "label", "confidence", "onset_anchored"
    )
