"""Sections of a song from its bars: micro breaks, internal splits, grouping of phrase blocks, and characters.

Features of bars and sections are whole thousandths, so that sums and quantiles are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins
from .windows import ENTITY

#: Bounds in thousandths. Fixed values, as are the labels and the numbers in the conditions below.
SIMILARITY, ENERGY_DELTA, ENTRY_JUMP, INTRO_CONTRAST = 0.9, 60, 80, 1500
SPLIT_BARS, SPLIT_CONTRAST, SPLIT_ADVANTAGE, SPLIT_ENERGY, SPLIT_ONSET, SPLIT_DRUMS, SPLIT_SUSTAINED = 2, 900, 280, 120, 120, 180, 80
FEATURES = ["energy", "onset", "flux", "vocals", "drums", "harmonic", "bass"]


def micro_breaks(bars: DataFrame, sections: DataFrame) -> DataFrame:
    """Breaks of one to four bars: from a bar of low energy, or of drums without vocals, to the last bar that still
    meets the looser test. Those that begin where a section (start_t) does are none. Columns: start_t, end_t,
    first_bar, bar_count, break_type."""
    c = F.col
    drummed = lambda onset: (c("drums") >= 550) & (c("vocals") <= 200) & (c("onset") <= onset)
    marked = bars.withColumns({"_strict": (c("energy") <= 250) | drummed(500), "_loose": (c("energy") <= 300) | drummed(550)})
    # runs of bars that meet the looser test; a break is a run from its first bar that meets the stricter one
    by_bar = Window.partitionBy(ENTITY).orderBy("bar")
    runs = marked.withColumn("_run", F.sum(F.when(c("_loose"), 0).otherwise(1)).over(by_bar)).where("_loose")
    first = F.min(F.when(c("_strict"), c("bar"))).over(Window.partitionBy(ENTITY, "_run"))
    found = runs.withColumn("_first", first).where("bar >= _first").groupBy(ENTITY, "_run").agg(
        F.min("start_t").alias("start_t"), F.max_by("end_t", "bar").alias("end_t"), F.min("bar").alias("first_bar"), F.count("*").alias("bar_count"), F.sum("drums").alias("_d"), F.sum("energy").alias("_e")
    )
    kind = F.when(c("bar_count") <= 2, "pause_break").when((c("_d") >= 550 * c("bar_count")) & (c("_e") >= 250 * c("bar_count")), "percussion_break").otherwise("breath_space")
    starts = sections.select(ENTITY, "start_t").distinct()
    return found.where("bar_count <= 4").join(starts, [ENTITY, "start_t"], "left_anti").select(ENTITY, "start_t", "end_t", "first_bar", "bar_count", kind.alias("break_type"))


def split_at_breaks(sections: DataFrame, breaks: DataFrame) -> DataFrame:
    """Sections (section, start_t, end_t, label, confidence) with the first break of three or four bars strictly
    inside each set apart: left, break and right part, numbered anew. Shorter breaks change nothing."""
    c = F.col
    wide = breaks.where("bar_count >= 3").select(ENTITY, c("start_t").alias("_s"), c("end_t").alias("_t"), "break_type")
    # sections do not overlap, so a break starts in one at most
    held = joins.containing(wide, sections.select(ENTITY, "section", "start_t", "end_t"), time="_s").where((c("inside._at") < c("_s")) & (c("_t") < c("inside.end_t")))
    first = held.groupBy(ENTITY, c("inside.section").alias("section")).agg(F.min(F.struct("_s", "_t", "break_type")).alias("_b"))
    part = lambda start, end, label, sure: F.struct(start.alias("start_t"), end.alias("end_t"), label.alias("label"), sure.alias("confidence"))
    weaker = F.round(F.greatest(F.lit(0.4), c("confidence") * 0.8), 6)
    own = (c("label"), c("confidence"))
    parts = F.when(c("_b").isNull(), F.array(part(c("start_t"), c("end_t"), *own))).otherwise(F.array(part(c("start_t"), c("_b._s"), *own), part(c("_b._s"), c("_b._t"), c("_b.break_type"), weaker), part(c("_b._t"), c("end_t"), *own)))
    out = sections.join(first, [ENTITY, "section"], "left").select(ENTITY, F.explode(parts).alias("_p")).select(ENTITY, "_p.*")
    number = F.row_number().over(Window.partitionBy(ENTITY).orderBy("start_t", "end_t"))
    return out.withColumn("section_id", F.format_string("section-%03d", number))


def internal_splits(bars: DataFrame) -> DataFrame:
    """The bar at which each section is split: of bars (section, bar, start_t, contrast, energy, onset, drums) at
    least two from either end, the one of highest contrast, the later of equals, where contrast stands out in the
    section and energy, onset and drums rise and stay up."""
    c = F.col
    w = Window.partitionBy(ENTITY, "section").orderBy("bar")
    whole = Window.partitionBy(ENTITY, "section")
    left, right = w.rowsBetween(-SPLIT_BARS, -1), w.rowsBetween(0, SPLIT_BARS - 1)
    placed = bars.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count("*").over(whole)})
    offered = (c("_i") >= SPLIT_BARS) & (c("_i") <= c("_n") - SPLIT_BARS)
    sums = {f"_{side}_{f}": F.sum(f).over(frame) for side, frame in (("l", left), ("r", right)) for f in ("energy", "onset", "drums")}
    sums |= {f"_low_{f}": F.min(f).over(right) for f in ("energy", "onset")}
    seen = F.when(offered, c("contrast"))
    rows = placed.withColumns(sums | {"_sum": F.sum(seen).over(whole), "_count": F.count(seen).over(whole)})
    rise = lambda f, least: c(f"_r_{f}") - c(f"_l_{f}") >= least * SPLIT_BARS
    stays = lambda f: c(f"_low_{f}") * SPLIT_BARS >= c(f"_l_{f}") + SPLIT_SUSTAINED * SPLIT_BARS
    good = offered & (c("contrast") >= SPLIT_CONTRAST) & (c("contrast") * c("_count") >= c("_sum") + SPLIT_ADVANTAGE * c("_count"))
    good = good & rise("energy", SPLIT_ENERGY) & rise("onset", SPLIT_ONSET) & rise("drums", SPLIT_DRUMS) & stays("energy") & stays("onset")
    return rows.where(good).groupBy(ENTITY, "section").agg(F.max_by("bar", F.struct("contrast", "start_t")).alias("split_bar"))


def apply_splits(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """Sections of the bars, cut at their splits: bar_start, bar_end, times, bar count, sums of the features, and
    whether the start is one that must stay."""
    c = F.col
    joined = bars.join(splits, [ENTITY, "section"], "left").withColumn("_part", F.coalesce((c("bar") >= c("split_bar")).cast("int"), F.lit(0)))
    return joined.groupBy(ENTITY, "section", "_part").agg(
        F.min("bar").alias("bar_start"), F.max("bar").alias("bar_end"), F.min("start_t").alias("start_t"), F.max_by("end_t", "bar").alias("end_t"), F.count("*").alias("bar_count"), *[F.sum(f).alias(f"{f}_sum") for f in ("energy", "onset", "drums")]
    ).withColumn("preserve_start", c("_part") == 1).drop("_part")


def group_blocks(blocks: DataFrame) -> DataFrame:
    """blocks (entity_id, block, energy, contrast, vector) with ``grp``: neighbours paired where their unit vectors
    are alike, their energies near, and the first does not jump up from the group before. A quiet pair of
    opening blocks goes first, unless the boundary between them stands out. Sequential, so one task takes one
    entity's blocks, some dozens for a song."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block").reset_index(drop=True)
        energy, vectors, n = pdf["energy"].to_numpy(dtype=float), np.stack(pdf["vector"].to_numpy()), len(pdf)
        alike = [float(vectors[i] @ vectors[i + 1]) >= SIMILARITY for i in range(n - 1)]
        out, i, g, before = np.zeros(n, dtype=int), 0, 0, None
        keep_intro = n >= 2 and pd.notna(pdf["contrast"][1]) and pdf["contrast"][1] >= INTRO_CONTRAST
        if n >= 2 and alike[0] and not keep_intro:
            intro = (energy[0] + energy[1]) / 2
            if intro < (np.median(energy[2:]) if n > 2 else intro):
                i, g, before = 2, 1, energy[1]
        while i < n:
            size = 1
            if i < n - 1 and not (i == 0 and keep_intro):
                jump = before is not None and energy[i] - before > ENTRY_JUMP
                if not jump and alike[i] and abs(energy[i] - energy[i + 1]) <= ENERGY_DELTA:
                    size = 2
            out[i : i + size] = g
            i, g, before = i + size, g + 1, energy[i + size - 1]
        return pd.DataFrame({ENTITY: pdf[ENTITY], "block": pdf["block"], "grp": out})

    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema.fields}
    return blocks.groupBy(ENTITY).applyInPandas(run, f"{ENTITY} {kinds[ENTITY]}, block {kinds['block']}, grp int")


def merge_groups(blocks: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    """One row for each group: first and last block, bar count, mean energy, and the members' mean vector (of
    ``size`` components), of unit length unless it is zero."""
    joined = blocks.join(groups, [ENTITY, "block"])
    merged = joined.groupBy(ENTITY, "grp").agg(F.min("block").alias("first_block"), F.max("block").alias("last_block"), F.sum("bar_count").alias("bar_count"), (F.sum("energy") / F.count("*")).alias("energy"), *[F.avg(F.col("vector")[i]).alias(f"_v{i}") for i in range(size)])
    vector = F.array(*[F.col(f"_v{i}") for i in range(size)])
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return merged.withColumn("_length", length).withColumn("vector", F.transform(vector, lambda x: F.when(F.col("_length") > 0, x / F.col("_length")).otherwise(x))).drop("_length", *[f"_v{i}" for i in range(size)])


def characters(sections: DataFrame) -> DataFrame:
    """sections (section, features in thousandths, repetition) with ``character``, by the first of fourteen
    conditions that holds; quantiles are those of the entity's sections, from one group-by."""
    c = F.col
    order = Window.partitionBy(ENTITY).orderBy("section")
    rows = sections.withColumn("motion", c("onset") + c("flux"))  # twice the motion
    # linearly interpolated quantiles of whole numbers at twentieths are whole twentieths
    cuts = {"energy": (("el", 0.35), ("eh", 0.7), ("ep", 0.85)), "motion": (("ml", 0.35), ("mh", 0.7)), "repetition": (("rm", 0.5),)}
    found = rows.groupBy(ENTITY).agg(F.count("*").alias("_n"), *[F.percentile(x, F.array(*[F.lit(q) for _, q in at])).alias(f"_p_{x}") for x, at in cuts.items()])
    twentieths = [F.round(F.get(f"_p_{x}", F.lit(i)) * 20).cast("long").alias(f"_{name}") for x, at in cuts.items() for i, (name, _) in enumerate(at)]
    rows = rows.join(found.select(ENTITY, "_n", *twentieths), ENTITY)
    rows = rows.withColumns({
        "_i": F.row_number().over(order) - 1, "_delta": c("energy") - F.coalesce(F.lag("energy").over(order), c("energy")),
        "_next_e": F.coalesce(F.lead("energy").over(order), c("energy")), "_next_m": F.coalesce(F.lead("motion").over(order), c("motion")), "_next_d": F.coalesce(F.lead("drums").over(order), c("drums")),
    })
    e, m, r = c("energy") * 20, c("motion") * 20, c("repetition") * 20
    v, d, h, b, delta = c("vocals"), c("drums"), c("harmonic"), c("bass"), c("_delta")
    moving, rare = m >= c("_mh"), r < c("_rm")
    label = (
        F.when((c("_i") == 0) & (v >= 450) & (d <= 200), "vocal_spotlight")
        .when(c("_i") == 0, "ambient_opening")
        .when(c("_i") == c("_n") - 1, "release_tail")
        .when(rare & (c("_next_e") - c("energy") >= 120) & (c("_next_m") * 20 >= c("_mh")) & (c("_next_d") >= 450), "contrast_bridge")
        .when((v * 10 >= F.greatest((d + 200) * 10, h * 8)) & (d * 40 <= c("_ml") + 2000), F.when(e >= c("_eh"), "vocal_lift").otherwise("vocal_spotlight"))
        .when((h + b >= 700) & (v <= 250) & (d <= 450), "instrumental_bed")
        .when((h >= 450) & (d <= 300) & (delta >= 40) & (v <= 250), "arpeggiated_lift")
        .when((delta >= ENTRY_JUMP) & moving & (d >= 450) & ((v >= 100) | (b >= 350) | (h >= 120)), "momentum_lift")
        .when((d >= 550) & (h <= 350) & (v <= 250), "percussion_break")
        .when((e >= c("_ep")) & (~rare | moving), "focal_lift")
        .when((delta >= 40) & moving, "momentum_lift")
        .when((e <= c("_el")) & (m <= c("_ml") + 400), "breath_space")
        .when((c("_i") == 1) & (e <= c("_el") + 200) & (m <= c("_mh") - 800), "breath_space")
        .when(rare & (moving | (F.abs(delta) >= 50)), "contrast_bridge")
        .when(moving | (e >= c("_eh")), "groove_plateau")
        .otherwise("flowing_plateau")
    )
    return rows.withColumn("character", label).drop("motion", *[f"_{x}" for x in ("el", "eh", "ep", "ml", "mh", "rm", "i", "n", "delta", "next_e", "next_m", "next_d")])
