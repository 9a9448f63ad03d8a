"""Event rules as data: thresholds from each entity's statistics, and all rules in one pass over the rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import ENTITY, extremum


@dataclass
class Rule:
    """An event type, its condition over feature rows, and how its confidence is computed. Rules
    that merge join consecutive rows into one event."""

    kind: str
    when: Column
    confidence: Column
    merge: bool = False
    evidence: list[str] = field(default_factory=list)


def thresholds(rows: DataFrame, bounds: dict[str, tuple[str, float]]) -> DataFrame:
    """rows with each bound, mean + k * sample deviation of a feature, from exact integer sums."""
    out = []
    for name, (x, k) in bounds.items():
        n, s, q = F.count(x), F.sum(x), F.sum(F.col(x) * F.col(x))
        deviation = F.when(n > 1, F.sqrt((n * q - s * s).cast("double")) / F.sqrt((n * (n - 1)).cast("double"))).otherwise(0.0)
        out.append((s / n + F.lit(k) * deviation).alias(name))
    return rows.join(rows.groupBy(ENTITY).agg(*out), ENTITY)


def apply_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Events of all rules: entity_id, type, start_t, end_t, first_idx, last_idx, confidence (of the
    strongest row). rows need idx, t, end_t."""
    # every row lists the rules it meets and is exploded once, so that rows are computed once for all rules
    listed = F.array_compact(F.array(*[F.when(r.when, F.struct(F.lit(r.kind).alias("type"), F.lit(r.merge).alias("_merge"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), r.confidence)).alias("_c"))) for r in rules]))
    hits = rows.select(ENTITY, "idx", "t", "end_t", F.explode(listed).alias("_r")).select(ENTITY, "idx", "t", "end_t", "_r.*")
    place = F.row_number().over(Window.partitionBy(ENTITY, "type").orderBy("idx"))
    islands = hits.withColumn("_k", F.when(F.col("_merge"), F.col("idx") - place).otherwise(F.col("idx")))
    return islands.groupBy(ENTITY, "type", "_k").agg(
        F.min("t").alias("start_t"), F.max("end_t").alias("end_t"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.max("_c").alias("confidence")
    ).drop("_k")


def without_following(events: DataFrame, others: DataFrame, within: int) -> DataFrame:
    """Events after whose end no other starts within the time, by an anti-join on time buckets."""
    spread = events.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("end_t") / within), F.floor((F.col("end_t") + within) / within)))).select(ENTITY, "start_t", "end_t", "_bucket")
    starts = others.select(F.col(ENTITY).alias("_e"), F.col("start_t").alias("_s"), F.floor(F.col("start_t") / within).alias("_b"))
    hit = spread.join(starts, (F.col(ENTITY) == F.col("_e")) & (F.col("_bucket") == F.col("_b")) & (F.col("_s") > F.col("end_t")) & (F.col("_s") <= F.col("end_t") + within), "left_semi")
    return events.join(hit.select(ENTITY, "start_t", "end_t").distinct(), [ENTITY, "start_t", "end_t"], "left_anti")


def layer_changes(rows: DataFrame, x: str, change: str, bound: int) -> DataFrame:
    """Rows where a layer comes in or goes: a change beyond the bound at a local extremum."""
    marked = rows.withColumns({"_hi": extremum(x), "_lo": extremum(x, low=True)})
    kind = F.when((F.col(change) >= bound) & F.col("_hi"), "layer_add").when((F.col(change) <= -bound) & F.col("_lo"), "layer_remove")
    return marked.withColumn("type", kind).where("type is not null").drop("_hi", "_lo")


def pick_variant(rows: DataFrame, scores: dict[str, Column], least: float, lead: float) -> DataFrame:
    """rows with ``variant``, the name of the top score if it reaches ``least`` and leads the second
    by ``lead``; and the top score. Equal scores keep the order given."""
    table = F.array(*[F.struct((-s).alias("o"), F.lit(i).alias("i"), F.lit(n).alias("name"), s.alias("score")) for i, (n, s) in enumerate(scores.items())])
    ranked = rows.withColumn("_s", F.array_sort(table))
    top, second = F.col("_s")[0]["score"], F.col("_s")[1]["score"]
    return ranked.withColumns({"variant": F.when((top >= least) & (top - second >= lead), F.col("_s")[0]["name"]), "top_score": top}).drop("_s")


def apply_overrides(events: DataFrame, operations: DataFrame) -> DataFrame:
    """Events after their operations (event_id, seq, action, start_t, end_t, type, note) in order:
    retime, relabel, annotate and confirm change fields, the last of each kind wins; delete removes
    the event and ends the list. Adds ``status``."""
    cut = operations.groupBy("event_id").agg(F.min(F.when(F.col("action") == "delete", F.col("seq"))).alias("_deleted"))
    kept = operations.join(cut, "event_id").where("_deleted is null or seq < _deleted")
    last = lambda action, value: F.max_by(F.when(F.col("action") == action, F.struct(value)), F.when(F.col("action") == action, F.col("seq")))
    merged = kept.groupBy("event_id").agg(last("retime", "start_t").alias("_s"), last("retime", "end_t").alias("_e"), last("relabel", "type").alias("_t"), last("annotate", "note").alias("_n"), F.max_by("action", "seq").alias("_a"))
    out = events.join(cut.where("_deleted is not null").select("event_id"), "event_id", "left_anti").join(merged, "event_id", "left")
    return out.withColumns(
        {"start_t": F.coalesce("_s.start_t", "start_t"), "end_t": F.coalesce("_e.end_t", "end_t"), "type": F.coalesce("_t.type", "type"), "note": F.col("_n.note"), "status": F.coalesce("_a", F.lit("generated"))}
    ).drop("_s", "_e", "_t", "_n", "_a")


def review_band(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "high").when(confidence >= 0.55, "medium").otherwise("low")
