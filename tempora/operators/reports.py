"""Cards of songs, lists of first members, exports and reports over finished tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins
from .windows import ENTITY, order

#: Targets of the validation report, in order. Fixed values.
TARGETS = ["beats", "chords", "sections", "energy", "patterns", "unified", "events", "drums"]


def mean_cards(rows: DataFrame, by: Column, x: str, name: str, as_: str) -> DataFrame:
    """(entity_id, <name>, <as_>): the mean of x over each group, to six digits."""
    return rows.groupBy(ENTITY, by.alias(name)).agg(F.round(F.sum(x) / F.count(x), 6).alias(as_))


def extremes(cards: DataFrame, x: str, place: str) -> DataFrame:
    """(entity_id, low, high, loudest, quietest): the least and largest x, for scaling, and the first places that have them."""
    return cards.groupBy(ENTITY).agg(F.min(x).alias("low"), F.max(x).alias("high"), F.max_by(place, F.struct(x, -F.col(place))).alias("loudest"), F.min_by(place, F.struct(x, place)).alias("quietest"))


def dominant_motif(motifs: DataFrame, least: int = 2) -> DataFrame:
    """(entity_id, dominant_motif): of motifs (motif, occurrences, refs) that occur ``least`` times the one of most occurrences, then refs, then the later name."""
    return motifs.where(F.col("occurrences") >= least).groupBy(ENTITY).agg(F.max_by("motif", F.struct("occurrences", "refs", "motif")).alias("dominant_motif"))


def conditions_counted(rows: DataFrame, conditions: dict[str, Column], medians: dict[str, str] | None = None) -> DataFrame:
    """How many rows of each entity meet each condition, and medians of columns."""
    return rows.groupBy(ENTITY).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()], *[F.median(x).alias(n) for n, x in (medians or {}).items()])


def first_in_windows(rows: DataFrame, spans: DataFrame, width: int, key: str, most: int = 6, name: str = "anchors") -> DataFrame:
    """(entity_id, key, <name>): ids of the first ``most`` rows (event_id, t) in each span (key, start_t, end_t), both ends included, in order of time. Rows are
    ranked before any list is gathered."""
    met = joins.in_range(rows.select(ENTITY, "event_id", "t"), spans, width, closed=True)
    placed = met.withColumn("_n", F.row_number().over(Window.partitionBy(ENTITY, key).orderBy("t", "event_id"))).where(F.col("_n") <= most)
    return placed.groupBy(ENTITY, key).agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "event_id"))), lambda x: x["event_id"]).alias(name))


def list_relations(lists: DataFrame, own: str, other: str) -> DataFrame:
    """lists with ``ordered`` (own without repeats, in order), ``shared`` (how many values both have) and ``subset`` (whether the other has all of own's)."""
    return lists.withColumns({"ordered": F.array_distinct(own), "shared": F.size(F.array_intersect(own, other)), "subset": F.size(F.array_except(own, other)) == 0})


def looked_up(x: Column, table: dict[str, str], otherwise: str) -> Column:
    """The table's value for x, or the general one."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for pair in table.items() for v in pair]), x), F.lit(otherwise)) if table else F.lit(otherwise)


def threshold_profile(genre: Column, profiles: list[str]) -> Column:
    """The profile named like a genre (lower case, blanks as underscores), else the default one."""
    return looked_up(F.replace(F.lower(genre), F.lit(" "), F.lit("_")), {p: p for p in profiles}, "default")


def exported_events(events: DataFrame, hints: dict[str, str], general: str) -> DataFrame:
    """Compact rows of events (event_id, type, start_t, end_t, edited, created_by): provenance, maker and a lighting hint by type."""
    return events.select(
        "event_id", "type", "start_t", "end_t", F.when(F.col("edited"), "human-edited").otherwise("machine-only").alias("provenance"), F.coalesce("created_by", F.lit("unknown")).alias("created_by"), looked_up(F.col("type"), hints, general).alias("lighting_hint")
    )


def target_report(entities: DataFrame, checks: DataFrame, asked: list[str], strict: Column, targets: list[str] = TARGETS) -> DataFrame:
    """(entity_id, target, matched, mismatched, status, exit_code): every target of each entity from checks (target, ok). Targets that are not asked for are skipped; others fail by
    any mismatch. The exit code is 1 where one fails and ``strict`` holds."""
    counts = checks.groupBy(ENTITY, "target").agg(F.count_if("ok").alias("matched"), F.count_if(~F.col("ok")).alias("mismatched"))
    every = entities.select(ENTITY).withColumn("target", F.explode(F.array(*[F.lit(x) for x in targets])))
    joined = every.join(counts, [ENTITY, "target"], "left").fillna(0, ["matched", "mismatched"])
    wanted, wrong = F.col("target").isin(asked), F.col("mismatched") > 0
    status = F.when(~wanted, "skipped").when(wrong, "failed").otherwise("passed")
    codes = joined.groupBy(ENTITY).agg(F.max(F.when(wanted & wrong & strict, 1).otherwise(0)).alias("exit_code"))
    return joined.withColumn("status", status).join(codes, ENTITY)


def window_events(rows: DataFrame, probability: Column, size: int = 256, step: int = 128, least: float = 0.8) -> DataFrame:
    """(entity_id, start_t, end_t, probability): windows of ``size`` rows every ``step`` from the first row, whole ones only, whose probability, an expression
    over the window's sums ``s`` and count ``n`` of the column ``x``, is above ``least``."""
    w = order().rowsBetween(0, size - 1)
    placed = rows.withColumns({"s": F.sum("x").over(w), "n": F.count("*").over(w), "_last": F.max("t").over(w)}).withColumn("probability", probability)
    return placed.where(((F.col("idx") - 1) % step == 0) & (F.col("n") == size) & (F.col("probability") > least)).select(ENTITY, F.col("t").alias("start_t"), F.col("_last").alias("end_t"), "probability")


def timing_source(own: DataFrame, reference: DataFrame, least: int) -> DataFrame:
    """(entity_id, source, first_t): reference beats where there are ``least`` of them, else the inferred ones, with the first of those taken."""
    card = lambda df, p: df.groupBy(ENTITY).agg(F.min("t").alias(f"{p}_t"), F.count("*").alias(f"{p}_n"))
    use = F.coalesce(F.col("ref_n") >= least, F.lit(False))
    return card(own, "own").join(card(reference, "ref"), ENTITY, "left").select(ENTITY, F.when(use, "reference").otherwise("inferred").alias("source"), F.when(use, F.col("ref_t")).otherwise(F.col("own_t")).alias("first_t"))
