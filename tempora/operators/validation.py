"""Contract checks and validation reports, as DataFrames of violations and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import canonical_label
from .windows import ENTITY

#: Event types that the contract knows, and other names for some. Fixed values.
EVENT_TYPES = ["build", "breakdown", "drop", "fake_drop", "impact_hit", "pause_break", "groove_loop", "atmospheric_plateau", "tension_hold", "no_drop_plateau", "layer_add", "layer_remove"]
ALIASES = {"buildup": "build", "break": "breakdown", "impact": "impact_hit", "pause": "pause_break", "groove": "groove_loop"}


def violations(rows: DataFrame, rules: dict[str, Column], key: str = "event_id") -> DataFrame:
    """A row (key, violation) for each rule that a row breaks; a rule is a condition that must hold,
    and counts as broken where it is null."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return rows.select(key, F.explode(broken).alias("violation"))


def event_rules() -> dict[str, Column]:
    """The event contract: a known type, ordered times, confidence and intensity in 0..1."""
    return {
        "type": normal_type(F.col("type")).isin(EVENT_TYPES),
        "time_order": F.col("end_t") >= F.col("start_t"),
        "confidence": F.col("confidence").between(0, 1),
        "intensity": F.col("intensity").isNull() | F.col("intensity").between(0, 1),
    }


def normal_type(label: Column) -> Column:
    name = canonical_label(label)
    table = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.coalesce(table[name], name)


def unknown_keys(document: Column, allowed: list[str]) -> Column:
    """Keys of a JSON object that are not allowed, in order."""
    return F.array_sort(F.array_except(F.json_object_keys(document), F.array(*[F.lit(k) for k in allowed])))


def missing_keys(document: Column, needed: list[str]) -> Column:
    return F.array_sort(F.array_except(F.array(*[F.lit(k) for k in needed]), F.json_object_keys(document)))


def report(checks: DataFrame, target: str, least_ratio: float = 1.0, by: str = ENTITY) -> DataFrame:
    """checks (entity, ok) summed up: matched, mismatched, ratio and status."""
    counts = checks.groupBy(by).agg(F.count_if("ok").alias("matched"), F.count_if(~F.col("ok")).alias("mismatched"))
    ratio = F.col("matched") / (F.col("matched") + F.col("mismatched"))
    return counts.select(by, F.lit(target).alias("target"), "matched", "mismatched", ratio.alias("ratio"), F.when(ratio >= least_ratio, "passed").otherwise("failed").alias("status"))


def ordered_check(rows: DataFrame, *order: str, time: str = "t") -> DataFrame:
    """ok for each row whose time is not before the row before it."""
    w = Window.partitionBy(ENTITY).orderBy(*order)
    return rows.select(ENTITY, F.coalesce(F.col(time) >= F.lag(time).over(w), F.lit(True)).alias("ok"))


def disjoint_check(intervals: DataFrame, start: str = "start_t", end: str = "end_t") -> DataFrame:
    """ok for each interval that starts at or after the largest end before it."""
    w = Window.partitionBy(ENTITY).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return intervals.select(ENTITY, F.coalesce(F.col(start) >= F.max(end).over(w), F.lit(True)).alias("ok"))


def reference_check(rows: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """ok for each row whose key is among the known ones of its entity."""
    keys = known.select(F.col(ENTITY).alias("_e"), F.col(known_key).alias("_k")).distinct().withColumn("_ok", F.lit(True))
    return rows.join(keys, (F.col(ENTITY) == F.col("_e")) & (F.col(key) == F.col("_k")), "left").select(ENTITY, F.coalesce("_ok", F.lit(False)).alias("ok"))


def timing_diagnosis(deltas: DataFrame, delta: str = "delta") -> DataFrame:
    """Mean signed and absolute error, median, and counts of early and late rows."""
    return deltas.groupBy(ENTITY).agg(
        (F.sum(delta) / F.count(delta)).alias("mean_error"), (F.sum(F.abs(delta)) / F.count(delta)).alias("mean_absolute"), F.median(delta).alias("median_error"), F.count_if(F.col(delta) < 0).alias("early"), F.count_if(F.col(delta) > 0).alias("late")
    )


def exit_code(codes: DataFrame, code: str = "code") -> DataFrame:
    """3 if any code is other than 0 and 1, else 1 if any is 1, else 0; passed and failed counts."""
    worst = F.max(F.when(F.col(code) == 0, 0).when(F.col(code) == 1, 1).otherwise(3))
    return codes.agg(F.coalesce(worst, F.lit(0)).alias("exit_code"), F.count_if(F.col(code) == 0).alias("passed"), F.count_if(F.col(code) != 0).alias("failed"))
