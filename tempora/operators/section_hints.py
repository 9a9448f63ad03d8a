"""Hints for sections: transition roles, shapes, phrase boundaries, recalls and variation rules, as rows with text and anchors.

A section's hints come from its own card, its phrases and the section before; what recurs is known from a group-by over
phrase groups. All hints of a section are listed in one array and exploded once, so sections are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ladder
from .windows import ENTITY

#: Labels after which, and labels into which, a section is a cue reset; what its state is called; and the other states'
#: name. Fixed values.
OPENERS = ["contrast_bridge", "breath_space", "ambient_opening"]
STATES = {"groove_plateau": "new pulse state", "momentum_lift": "new pulse state", "flowing_plateau": "new pulse state", "focal_lift": "new focal state", "vocal_lift": "new focal state", "vocal_spotlight": "new focal state", "instrumental_bed": "new accompaniment-led state", "percussion_break": "new drum-led state"}
#: Words for density, sustain and repetition, from the least bound up. Fixed values.
DENSITY = [(18.0, "very dense activity"), (12.0, "dense activity"), (7.0, "moderate activity"), (3.0, "light activity")]
SUSTAIN = [(0.15, "long-held notes"), (0.08, "mixed sustain"), (0.04, "mostly short notes")]
REPETITION = [(0.75, "strong repetition"), (0.4, "moderate repetition"), (0.15, "occasional repetition")]
#: Least repetition for a variation rule, phrases that anchors name, and groups that a recall names. Fixed values.
VARIES, ANCHORS, NAMED = 0.15, 4, 3


def worded(x: Column, bounds: list[tuple[float, str]], least: str, unknown: str) -> Column:
    """The word of the highest bound that x reaches."""
    return F.when(x.isNull(), unknown).otherwise(ladder(x, bounds, least))


def phrase_lists(phrases: DataFrame) -> DataFrame:
    """(entity_id, section, phrase_ids, group_ids): the first phrases of a section, and its groups in order of first appearance;
    phrases (section, phrase_id, phrase_group, start_t). A section's groups are few; its phrases are ranked before they are gathered."""
    inside = phrases.where(F.col("section").isNotNull())
    placed = inside.withColumn("_n", F.row_number().over(Window.partitionBy(ENTITY, "section").orderBy("start_t", "phrase_id")))
    listed = lambda value: F.transform(F.array_sort(F.collect_list(value)), lambda x: x["id"])
    first = placed.where(F.col("_n") <= ANCHORS).groupBy(ENTITY, "section").agg(listed(F.struct(F.col("_n").alias("n"), F.col("phrase_id").alias("id"))).alias("phrase_ids"))
    groups = placed.groupBy(ENTITY, "section", "phrase_group").agg(F.min("_n").alias("n")).groupBy(ENTITY, "section").agg(listed(F.struct("n", F.col("phrase_group").alias("id"))).alias("group_ids"))
    return first.join(groups, [ENTITY, "section"])


def recalls(phrases: DataFrame, repeated: DataFrame) -> DataFrame:
    """(entity_id, section, recurring, motifs): the repeated groups (phrase_group, place, motif or null) that stand in a section, in
    order of place, and the motifs of those that have one."""
    met = phrases.where(F.col("section").isNotNull()).select(ENTITY, "section", "phrase_group").distinct().join(repeated, [ENTITY, "phrase_group"])
    listed = met.groupBy(ENTITY, "section").agg(F.array_sort(F.collect_list(F.struct("place", "phrase_group", "motif"))).alias("_g"))
    return listed.select(ENTITY, "section", F.transform("_g", lambda g: g["phrase_group"]).alias("recurring"), F.array_compact(F.transform("_g", lambda g: g["motif"])).alias("motifs"))


def section_hints(sections: DataFrame, cards: DataFrame, phrases: DataFrame, repeated: DataFrame, seconds: float = 1e6) -> DataFrame:
    """(entity_id, section, place, id, category, text, phrase_window_ids, phrase_group_ids, motif_group_ids) of sections (section in order, section_id,
    start_t, label), their cards (section, texture, melodic_contour, density_mean, sustain_ratio, repetition_score), phrases and
    repeated groups. A section without a card has no shape and no variation rule; one without phrases has no boundaries."""
    c, none = F.col, F.array().cast("array<string>")
    before = F.lag("label").over(Window.partitionBy(ENTITY).orderBy("section"))
    held = sections.withColumn("_before", before).join(cards.withColumn("_card", F.lit(True)), [ENTITY, "section"], "left").join(phrase_lists(phrases), [ENTITY, "section"], "left").join(recalls(phrases, repeated), [ENTITY, "section"], "left")
    held = held.withColumns({n: F.coalesce(n, none) for n in ("phrase_ids", "group_ids", "recurring", "motifs")})
    spaced = F.replace(c("label"), F.lit("_"), F.lit(" "))
    state = F.try_element_at(F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair]), c("label"))
    resets = (c("_before") != c("label")) & c("_before").isin(OPENERS) & c("label").isin(list(STATES))
    carded = c("_card").isNotNull()
    repetition = worded(c("repetition_score"), REPETITION, "limited repetition", "unknown repetition")
    named = lambda ids: F.array_join(F.slice(ids, 1, NAMED), ", ")

    def hint(place: int, when: Column, category: str, text: Column, phrases_: Column = none, groups: Column = none, motifs: Column = none) -> Column:
        fields = {"place": F.lit(place), "category": F.lit(category), "text": text, "phrase_window_ids": phrases_, "phrase_group_ids": groups, "motif_group_ids": motifs}
        return F.when(when, F.struct(*[v.alias(n) for n, v in fields.items()]))

    recur = F.size("recurring") > 0
    hints = F.array_compact(F.array(
        hint(1, resets, "transition_role", F.format_string("Treat %.2fs as the main cue reset into this %s; let the %s land on the boundary instead of drifting late.", F.round(c("start_t") / seconds, 2), spaced, state)),
        hint(2, carded, "section_shape", F.format_string("%s reads as a %s section with %s contour, %s, and %s.", spaced, "texture", "melodic_contour", worded(c("density_mean"), DENSITY, "sparse activity", "unknown activity"), worded(c("sustain_ratio"), SUSTAIN, "clipped note lengths", "unknown sustain")), c("phrase_ids"), c("group_ids")),
        hint(3, F.size("phrase_ids") > 0, "phrase_boundaries", F.format_string("Treat phrase anchors %s as the main internal cue boundaries inside this section.", F.array_join("phrase_ids", ", ")), c("phrase_ids"), c("group_ids")),
        hint(4, recur, "motif_recall", F.concat(F.lit("Repeated material returns here through phrase groups "), named("recurring"), F.when(F.size("motifs") > 0, F.concat(F.lit(" via motifs "), named("motifs"))).otherwise(""), F.lit("; keep recalls visibly related instead of inventing a disconnected look.")), c("phrase_ids"), c("recurring"), c("motifs")),
        hint(4, ~recur & carded & (F.coalesce("repetition_score", F.lit(0.0)) >= VARIES), "variation_rule", F.format_string("This section carries %s; vary recalled looks deliberately instead of resetting to an unrelated scene.", repetition), c("phrase_ids"), c("group_ids")),
    ))
    listed = held.select(ENTITY, "section", "section_id", F.explode(hints).alias("_h"))
    return listed.select(ENTITY, "section", "_h.place", F.concat("section_id", F.lit("-inference-"), "_h.category").alias("id"), "_h.category", "_h.text", "_h.phrase_window_ids", "_h.phrase_group_ids", "_h.motif_group_ids")


def merged_hints(inferred: DataFrame, given: DataFrame) -> DataFrame:
    """Hints of people and of inference together: given (entity_id, section_id, place, id, category, text) come first in their section, and sections that
    only they have are kept behind the others: (entity_id, section_id, source, place, id, category, text, preserved)."""
    columns = [ENTITY, "section_id", "source", "place", "id", "category", "text"]
    both = given.withColumn("source", F.lit("user")).select(columns).unionByName(inferred.withColumn("source", F.lit("inference")).select(columns))
    known = inferred.select(F.col(ENTITY).alias("_e"), F.col("section_id").alias("_s"), F.lit(True).alias("_known")).distinct()
    met = both.join(known, (F.col(ENTITY) == F.col("_e")) & (F.col("section_id") == F.col("_s")), "left")
    return met.select(*columns, F.col("_known").isNull().alias("preserved"))
