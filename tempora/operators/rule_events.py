"""Rule candidates over feature rows: thresholds from each entity's own statistics, all rules in one pass.

Every row lists the rules that it meets and is exploded once. Rows of one rule that follow each other in a
section become one event by a window, where the rule merges; then one group-by builds all events.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .beat_features import MILLION
from .rules import without_following
from .windows import ENTITY, extremum

#: Thresholds: name -> (feature, factor of its deviation, bound, whether the bound is the least). In
#: millionths. Fixed values.
DYNAMIC = {
    "build_energy_delta": ("energy_delta", 1.2, 40_000, True),
    "build_tension": ("tension_local", 0.8, 150_000, True),
    "build_energy": ("energy_score_local", 0.8, 250_000, True),
    "breakdown_energy_delta": ("energy_delta", -1.2, -100_000, False),
    "drop_energy_delta": ("energy_delta", 1.8, 100_000, True),
    "fake_drop_tension": ("tension_local", 1.0, 200_000, True),
    "groove_energy": ("energy_score_local", 0.5, 300_000, True),
    "atmo_energy": ("energy_score_local", -0.5, 100_000, True),
    "hold_tension": ("tension_local", 0.5, 300_000, True),
}
#: Constant thresholds, in millionths and microseconds. Fixed values.
BREAKDOWN_DENSITY_DELTA, DROP_ONSET, DROP_BASS, DROP_ACCENT = -150_000, 450_000, 250_000, 250_000
IMPACT_ACCENT, PAUSE_GAP, PAUSE_ENERGY = 650_000, 500_000, 400_000
GROOVE_BASS, GROOVE_VOLATILITY, ATMO_ONSET, ATMO_VOLATILITY = 300_000, 300_000, 300_000, 200_000
NO_DROP_ENERGY = (350_000, 600_000)
#: A pause is a fake drop where no drop starts within this time of its end.
RELEASE_WITHIN = 2_000_000


def entity_thresholds(rows: DataFrame) -> DataFrame:
    """(entity_id, entity_rows, th_<name>): each dynamic threshold is mean and factor times sample deviation of the entity's
    rows, no less (or no more) than the bound; with a single row both count as 0."""
    n, sums, columns = F.col("entity_rows"), [F.count("*").alias("entity_rows")], {}
    for x in sorted({f for f, *_ in DYNAMIC.values()}):
        sums += [F.sum(x).alias(f"_s_{x}"), F.sum((F.col(x).cast("decimal(18,0)") * F.col(x)).cast("decimal(37,0)")).cast("decimal(38,0)").alias(f"_q_{x}")]
        wide = F.col(f"_s_{x}").cast("decimal(38,0)")
        columns[f"_m_{x}"] = F.when(n > 1, F.col(f"_s_{x}") / n).otherwise(0.0)
        columns[f"_d_{x}"] = F.when(n > 1, F.sqrt((n.cast("decimal(38,0)") * F.col(f"_q_{x}") - wide * wide).cast("double") / (n * (n - 1)).cast("double"))).otherwise(0.0)
    value = lambda x, factor: F.col(f"_m_{x}") + F.lit(factor) * F.col(f"_d_{x}")
    bounds = {f"th_{name}": F.round((F.greatest if least else F.least)(F.lit(float(bound)), value(x, factor))).cast("long") for name, (x, factor, bound, least) in DYNAMIC.items()}
    return rows.groupBy(ENTITY).agg(*sums).withColumns(columns).withColumns(bounds).select(ENTITY, "entity_rows", *bounds)


def with_thresholds(rows: DataFrame) -> DataFrame:
    """rows with their entity's thresholds and number of rows. Statistics are partial sums by entity, joined back, so
    an entity of any size is spread over tasks; rows are best a table, as they are read twice."""
    return rows.join(entity_thresholds(rows), ENTITY)


#: Columns of an event, and values of its first row that records quote.
EVENT = [ENTITY, "type", "start_t", "end_t", "first_idx", "last_idx", "section", "confidence", "intensity"]
ROW_VALUES = ["energy_delta", "z_onset", "z_bass_activation", "z_accent_intensity", "z_energy_score", "silence_gap", "tension_local"]

#: Added before rounding to six digits: products of scores and weights that are halves in decimals are so only to
#: the last bit.
HALF_UP = 1e-9


def clamped(x: Column) -> Column:
    """Within 0..1, to six digits, halves up."""
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) + HALF_UP, 6)


def share(x: Column) -> Column:
    return x / F.lit(float(MILLION))


@dataclass
class Rule:
    """A rule: when a row meets it, two measures of the row (means of an event's rows where it merges), and
    confidence and intensity from these."""

    kind: str
    when: Column
    measures: tuple[Column, Column]
    confidence: Callable[[Column, Column], Column]
    intensity: Callable[[Column, Column], Column]
    merge: bool = False


def row_rules(pause_gap: int = PAUSE_GAP) -> list[Rule]:
    """Rules over rows with thresholds and ``cluster`` (0 low to 2 high). Weights are fixed values."""
    c, th = F.col, lambda name: F.col(f"th_{name}")
    strength = share(c("energy_delta")) * 0.2 + share(c("z_onset")) * 0.15 + share(c("z_bass_activation")) * 0.2
    return [
        Rule("build", (c("energy_delta") >= th("build_energy_delta")) & (c("tension_local") >= th("build_tension")) & (c("energy_score_local") >= th("build_energy")) & (c("cluster") >= 1), (c("energy_score_local"), c("tension_local")), lambda e, t: share(e) * 0.25 + share(t) * 0.3 + 0.45, lambda e, t: share(e), merge=True),
        Rule("breakdown", (c("energy_delta") <= th("breakdown_energy_delta")) & (c("density_delta") <= BREAKDOWN_DENSITY_DELTA) & (c("cluster") <= 1), (c("energy_delta"), c("density_delta")), lambda e, d: share(F.abs(e)) * 0.3 + share(F.abs(d)) * 0.2 + 0.45, lambda e, d: share(F.abs(e)), merge=True),
        Rule("drop", (c("cluster") == 2) & (c("energy_delta") >= th("drop_energy_delta")) & (c("z_onset") >= DROP_ONSET) & (c("z_bass_activation") >= DROP_BASS) & (c("z_accent_intensity") >= DROP_ACCENT), (F.least(F.lit(1.0), strength + 0.45), F.greatest("z_energy_score", "z_accent_intensity")), lambda a, b: a, lambda a, b: share(b)),
        Rule("impact_hit", (c("z_accent_intensity") >= IMPACT_ACCENT) & c("_accent_top"), (c("z_accent_intensity"), c("z_accent_intensity")), lambda a, b: share(a) * 0.5 + 0.4, lambda a, b: share(b)),
        Rule("pause_break", (c("silence_gap") >= pause_gap) & (c("z_energy_score") <= PAUSE_ENERGY) & (c("cluster") == 0), (share(c("silence_gap")), c("z_energy_score")), lambda g, e: g * 0.2 + 0.45, lambda g, e: F.greatest(F.lit(0.0), 1.0 - share(e))),
        Rule("_fake", (c("silence_gap") >= pause_gap) & (c("z_energy_score") <= PAUSE_ENERGY) & (c("cluster") == 0) & (c("tension_local") >= th("fake_drop_tension")), (c("tension_local"), c("tension_local")), lambda a, b: share(a) * 0.4 + 0.35, lambda a, b: share(b)),
    ]


def events_of(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Events of all rules: entity_id, type, start_t, end_t, first_idx, last_idx, section (at the start of the
    first row), confidence, intensity; the measures a and b, and ``row``, what records say of the first row and its
    thresholds. rows need idx, t, end_t, section and start_section."""
    table = F.array_compact(F.array(*[F.when(r.when, F.struct(F.lit(r.kind).alias("type"), F.lit(r.merge).alias("merge"), r.measures[0].cast("double").alias("a"), r.measures[1].cast("double").alias("b"))) for r in rules]))
    told = F.struct(*[c for c in [*ROW_VALUES, *[f"th_{n}" for n in DYNAMIC]] if c in rows.columns])
    hits = rows.select(ENTITY, "idx", "t", "end_t", "section", "start_section", told.alias("row"), F.explode(table).alias("_r")).select("*", "_r.*").drop("_r")
    place = F.row_number().over(Window.partitionBy(ENTITY, "type", "section").orderBy("idx"))
    islands = hits.withColumn("_k", F.when(F.col("merge"), F.col("idx") - place).otherwise(F.col("idx")))
    whole = islands.groupBy(ENTITY, "type", "section", "_k", "merge").agg(
        F.min("t").alias("start_t"), F.max("end_t").alias("end_t"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.min_by("start_section", "idx").alias("_s"), F.min_by("row", "idx").alias("row"), (F.sum("a") / F.count("*")).alias("_a"), (F.sum("b") / F.count("*")).alias("_b")
    )
    whole = whole.withColumns({m: F.when(F.col("merge"), F.round(m)).otherwise(F.col(m)) for m in ("_a", "_b")})
    pick = lambda what: F.coalesce(*[F.when(F.col("type") == r.kind, clamped(getattr(r, what)(F.col("_a"), F.col("_b")))) for r in rules])
    return whole.select(*EVENT[:-3], F.col("_s").alias("section"), pick("confidence").alias("confidence"), pick("intensity").alias("intensity"), F.col("_a").alias("a"), F.col("_b").alias("b"), "row")


def rule_candidates(rows: DataFrame, pause_gap: int = PAUSE_GAP, release_within: int = RELEASE_WITHIN) -> DataFrame:
    """Build, breakdown, drop, impact, pause and fake-drop events. A pause with tension that no drop follows in
    time is a fake drop as well."""
    marked = rows.withColumn("_accent_top", extremum("z_accent_intensity"))
    found = events_of(marked, row_rules(pause_gap))
    fakes = without_following(found.where("type = '_fake'"), found.where("type = 'drop'"), release_within)
    return found.where("type <> '_fake'").unionByName(fakes.withColumn("type", F.lit("fake_drop")))


def section_candidates(rows: DataFrame, events: DataFrame) -> DataFrame:
    """States of whole sections: groove_loop, atmospheric_plateau, tension_hold and no_drop_plateau, with the
    section's first and last row as the event's window; ``row`` has the section's means and thresholds."""
    mean = lambda x: F.round(F.sum(x) / F.count("*")).cast("long")
    cards = rows.where("section is not null").groupBy(ENTITY, "section").agg(
        mean("z_energy_score").alias("energy"), mean("z_onset").alias("onset"), mean("z_bass_activation").alias("bass"), mean("tension").alias("tension"),
        (F.max("z_energy_score") - F.min("z_energy_score")).alias("volatility"), F.min("t").alias("start_t"), F.max("end_t").alias("end_t"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"),
        *[F.max(f"th_{n}").alias(f"th_{n}") for n in ("groove_energy", "atmo_energy", "hold_tension")],
    )
    flags = events.where("section is not null").groupBy(ENTITY, "section").agg(F.max(F.col("type") == "build").alias("has_build"), F.max(F.col("type") == "drop").alias("has_drop"))
    joined = cards.join(flags, [ENTITY, "section"], "left").fillna(False, ["has_build", "has_drop"])
    c = F.col
    e, o, b, t = (share(c(x)) for x in ("energy", "onset", "bass", "tension"))
    states = [
        ("groove_loop", (c("energy") >= c("th_groove_energy")) & (c("bass") >= GROOVE_BASS) & (c("volatility") <= GROOVE_VOLATILITY), e * 0.2 + b * 0.2 + 0.45, e),
        ("atmospheric_plateau", (c("energy") <= c("th_atmo_energy")) & (c("onset") <= ATMO_ONSET) & (c("volatility") <= ATMO_VOLATILITY), (1.0 - e) * 0.2 + (1.0 - o) * 0.2 + 0.45, F.greatest(F.lit(0.0), 1.0 - e)),
        ("tension_hold", (c("tension") >= c("th_hold_tension")) & ~c("has_drop"), t * 0.35 + 0.4, t),
        ("no_drop_plateau", c("has_build") & ~c("has_drop") & c("energy").between(*NO_DROP_ENERGY), t * 0.25 + e * 0.15 + 0.4, e),
    ]
    table = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(kind).alias("type"), clamped(confidence).alias("confidence"), clamped(intensity).alias("intensity"))) for kind, when, confidence, intensity in states]))
    told = F.struct("energy", "onset", "bass", "tension", "volatility", "th_groove_energy", "th_atmo_energy", "th_hold_tension")
    return joined.select(ENTITY, "section", "start_t", "end_t", "first_idx", "last_idx", told.alias("row"), F.explode(table).alias("_s")).select(ENTITY, "_s.type", "start_t", "end_t", "first_idx", "last_idx", "section", "_s.confidence", "_s.intensity", "row")
