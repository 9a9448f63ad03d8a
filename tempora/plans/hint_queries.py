"""Queries of section hints, over sections, cards and phrases made from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import section_hints as hints
from .feature_queries import beats_of
from .registry import TL, query
from .timeline_queries import E

LABELS = ["breath_space", "groove_plateau", "contrast_bridge", "focal_lift", "ambient_opening", "percussion_break", "release_tail"]
TEXTURES, CONTOURS = ["sparse", "layered", "dense"], ["rising", "falling", "flat", "arched"]


def _pick(names: list[str], x):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (x % len(names) + 1).cast("int"))


def _picked(names: list[str], x: str) -> str:
    return f"[{', '.join(repr(n) for n in names)}][{x} % {len(names)} + 1]"


def _ladder(x: str, bounds: list[tuple[float, str]], least: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} >= {b}::DOUBLE THEN '{w}'" for b, w in bounds) + f" ELSE '{least}' END"


PARTS = f"""{TL}, en AS (SELECT * REPLACE (coalesce(k, 0) AS k), (idx - 1) // 8 AS section FROM tl),
s0 AS (SELECT entity_id, section, min(t) AS start_t, sum(k)::BIGINT AS sk, sum(energy)::BIGINT AS se FROM en GROUP BY 1, 2),
s AS (SELECT *, 'section-' || lpad((section + 1)::VARCHAR, 3, '0') AS section_id, {_picked(LABELS, 'sk')} AS label, lag({_picked(LABELS, 'sk')}) OVER (PARTITION BY entity_id ORDER BY section) AS before_ FROM s0),
cd AS (SELECT entity_id, section, {_picked(TEXTURES, 'se')} AS texture, {_picked(CONTOURS, 'sk')} AS contour, CASE WHEN sk % 6 = 0 THEN NULL ELSE se % 2500 / 100::DOUBLE END AS density, sk % 25 / 100::DOUBLE AS sustain, se % 100 / 100::DOUBLE AS repetition FROM s0 WHERE se % 7 <> 0),
ph AS (SELECT entity_id, section, 'phrase-' || (idx // 2)::VARCHAR AS id, 'group-' || (min(energy) % 9)::VARCHAR AS g, min(t) AS start_t FROM en WHERE section % 5 <> 4 GROUP BY entity_id, section, idx // 2),
rp AS (SELECT entity_id, g, count(*) AS n, min(start_t) AS place FROM ph GROUP BY 1, 2 HAVING count(*) >= 3),
rg AS (SELECT entity_id, g, place, CASE WHEN n >= 5 THEN 'motif-' || g END AS motif FROM rp),
pn AS (SELECT *, row_number() OVER (PARTITION BY entity_id, section ORDER BY start_t, id) AS n FROM ph),
pl AS (SELECT entity_id, section, string_agg(id, ', ' ORDER BY n) FILTER (n <= 4) AS ids FROM pn GROUP BY 1, 2),
gl AS (SELECT entity_id, section, string_agg(g, ', ' ORDER BY n) AS gs FROM (SELECT entity_id, section, g, min(n) AS n FROM pn GROUP BY 1, 2, 3) GROUP BY 1, 2),
rc AS (SELECT entity_id, section, list(g ORDER BY place, g) AS r, coalesce(list(motif ORDER BY place, g) FILTER (motif IS NOT NULL), []) AS m FROM (SELECT DISTINCT entity_id, section, g FROM ph) JOIN rg USING (entity_id, g) GROUP BY 1, 2),
h AS (SELECT s.*, texture, contour, density, sustain, repetition, coalesce(ids, '') AS ids, coalesce(gs, '') AS gs, coalesce(r, []) AS r, coalesce(m, []) AS m FROM s LEFT JOIN cd USING (entity_id, section) LEFT JOIN pl USING (entity_id, section) LEFT JOIN gl USING (entity_id, section) LEFT JOIN rc USING (entity_id, section))"""
_SPACED = "replace(label, '_', ' ')"
_STATE = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in hints.STATES.items()) + " END"
_IN = lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"


@query(
    "section_hints",
    f"""WITH {PARTS}
SELECT entity_id, section, section_id || '-inference-transition_role' AS id, printf('Treat %.2fs as the main cue reset into this %s; let the %s land on the boundary instead of drifting late.', round(start_t / 1000000::DOUBLE, 2), {_SPACED}, {_STATE}) AS text, '' AS phrases, '' AS groups_, '' AS motifs FROM h WHERE before_ <> label AND before_ IN {_IN(hints.OPENERS)} AND label IN {_IN(hints.STATES)}
UNION ALL SELECT entity_id, section, section_id || '-inference-section_shape', printf('%s reads as a %s section with %s contour, %s, and %s.', {_SPACED}, texture, contour, CASE WHEN density IS NULL THEN 'unknown activity' ELSE {_ladder('density', hints.DENSITY, 'sparse activity')} END, {_ladder('sustain', hints.SUSTAIN, 'clipped note lengths')}), ids, gs, '' FROM h WHERE texture IS NOT NULL
UNION ALL SELECT entity_id, section, section_id || '-inference-phrase_boundaries', 'Treat phrase anchors ' || ids || ' as the main internal cue boundaries inside this section.', ids, gs, '' FROM h WHERE ids <> ''
UNION ALL SELECT entity_id, section, section_id || '-inference-motif_recall', 'Repeated material returns here through phrase groups ' || array_to_string(r[1:3], ', ') || CASE WHEN len(m) > 0 THEN ' via motifs ' || array_to_string(m[1:3], ', ') ELSE '' END || '; keep recalls visibly related instead of inventing a disconnected look.', ids, array_to_string(r, ', '), array_to_string(m, ', ') FROM h WHERE len(r) > 0
UNION ALL SELECT entity_id, section, section_id || '-inference-variation_rule', 'This section carries ' || {_ladder('repetition', hints.REPETITION, 'limited repetition')} || '; vary recalled looks deliberately instead of resetting to an unrelated scene.', ids, gs, '' FROM h WHERE len(r) = 0 AND texture IS NOT NULL AND repetition >= {hints.VARIES}::DOUBLE""",
)
def section_hints(spark, sf_dir):
    rows = beats_of(spark, sf_dir).withColumn("section", F.floor((F.col("idx") - 1) / 8).cast("long"))
    sums = rows.groupBy(E, "section").agg(F.min("t").alias("start_t"), F.sum("k").alias("sk"), F.sum("energy").alias("se"))
    sections = sums.select(E, "section", F.format_string("section-%03d", F.col("section") + 1).alias("section_id"), "start_t", _pick(LABELS, F.col("sk")).alias("label"))
    cards = sums.where("se % 7 <> 0").select(E, "section", _pick(TEXTURES, F.col("se")).alias("texture"), _pick(CONTOURS, F.col("sk")).alias("melodic_contour"), F.when(F.col("sk") % 6 != 0, F.col("se") % 2500 / F.lit(100.0)).alias("density_mean"), (F.col("sk") % 25 / F.lit(100.0)).alias("sustain_ratio"), (F.col("se") % 100 / F.lit(100.0)).alias("repetition_score"))
    pairs = rows.where("section % 5 <> 4").groupBy(E, "section", F.floor(F.col("idx") / 2).alias("pair")).agg(F.min("t").alias("start_t"), F.min("energy").alias("e"))
    phrases = pairs.select(E, "section", F.format_string("phrase-%d", "pair").alias("phrase_id"), F.format_string("group-%d", F.col("e") % 9).alias("phrase_group"), "start_t")
    repeated = phrases.groupBy(E, "phrase_group").agg(F.count("*").alias("n"), F.min("start_t").alias("place")).where("n >= 3").select(E, "phrase_group", "place", F.when(F.col("n") >= 5, F.concat(F.lit("motif-"), "phrase_group")).alias("motif"))
    found = hints.section_hints(sections, cards, phrases, repeated)
    joined = lambda c: F.array_join(c, ", ")
    return found.select(E, "section", "id", "text", joined("phrase_window_ids").alias("phrases"), joined("phrase_group_ids").alias("groups_"), joined("motif_group_ids").alias("motifs"))
