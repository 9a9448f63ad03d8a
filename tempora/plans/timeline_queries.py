"""Queries over the timeline proxy: events per user as beats, types as labels, values as energy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import max_scale, min_max, overlap_ratio, scale_into, z_score
from ..operators import features, grid, joins, layers, sequences, windows
from ..sources.tables import timeline
from .registry import HOUR, TL, query

E = "entity_id"


def rows_of(spark: SparkSession, sf_dir: str, *labels: str) -> DataFrame:
    rows = timeline(spark, sf_dir)
    return rows.where(F.col("label").isin(*labels)) if labels else rows


def sections_of(rows: DataFrame) -> DataFrame:
    """Blocks of eight rows as sections, each ending at its last row, so that gaps stay between."""
    block = F.floor((F.col("idx") - 1) / 8).cast("long")
    return rows.groupBy(E, block.alias("section")).agg(F.min("t").alias("start_t"), F.max("t").alias("end_t"))


SECTIONS = "sections AS (SELECT entity_id, (idx - 1) // 8 AS section, min(t) AS start_t, max(t) AS end_t FROM tl GROUP BY ALL)"


@query(
    "grid_beats_bars",
    f"""WITH {TL}, gaps AS (SELECT entity_id, t - lag(t) OVER (PARTITION BY entity_id ORDER BY idx) AS gap, t FROM tl),
tails AS (SELECT entity_id, max(t) AS last_t, coalesce(median(gap), 0)::DOUBLE AS gap FROM gaps GROUP BY 1),
starts AS (SELECT entity_id, bar, t AS start_t, lead(t) OVER (PARTITION BY entity_id ORDER BY bar) AS next_start FROM tl WHERE beat_in_bar = 1)
SELECT entity_id, bar, start_t, coalesce(next_start::DOUBLE, last_t + gap) AS end_t FROM starts JOIN tails USING (entity_id)""",
)
def grid_beats_bars(spark, sf_dir):
    points = rows_of(spark, sf_dir).select(E, "t", "event_id")
    return grid.bars(grid.beats(points))


@query(
    "beat_windows",
    f"""WITH {TL}, gaps AS (SELECT entity_id, t - lag(t) OVER (PARTITION BY entity_id ORDER BY idx) AS gap, t FROM tl),
tails AS (SELECT entity_id, max(t) + coalesce(median(gap), 0)::DOUBLE AS last_end FROM gaps GROUP BY 1)
SELECT entity_id, event_id, t, coalesce(next_t::DOUBLE, last_end) AS end_t FROM tl JOIN tails USING (entity_id)""",
)
def beat_windows(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    return grid.window_ends(rows, grid.bars(rows)).select(E, "event_id", "t", "end_t")


@query(
    "section_blocks",
    f"""WITH {TL}, numbered AS (SELECT *, count(*) OVER (PARTITION BY entity_id) AS n FROM tl),
keyed AS (SELECT *, CASE WHEN (idx - 1) // 8 = n // 8 AND n % 8 < 4 AND n // 8 > 0 THEN n // 8 - 1 ELSE (idx - 1) // 8 END AS block FROM numbered)
SELECT entity_id, block, min(t) AS start_t, max(t) AS last_t, count(*) AS n_rows, sum(energy)::BIGINT AS energy_sum FROM keyed GROUP BY 1, 2""",
)
def section_blocks(spark, sf_dir):
    return grid.blocks(rows_of(spark, sf_dir), 8, ["energy"], least=4)


@query(
    "resample_grid",
    f"""WITH {TL}, spans AS (SELECT entity_id, min(t) AS a, max(t) AS b FROM tl GROUP BY 1),
points AS (SELECT entity_id, unnest(range(a, b + 1, {6 * HOUR})) AS grid_t FROM spans),
before AS (SELECT p.entity_id, p.grid_t, tl.t, tl.event_id, tl.energy FROM points p ASOF JOIN tl ON p.entity_id = tl.entity_id AND p.grid_t >= tl.t),
after AS (SELECT p.entity_id, p.grid_t, tl.t, tl.event_id, tl.energy FROM points p ASOF JOIN tl ON p.entity_id = tl.entity_id AND p.grid_t <= tl.t)
SELECT b.entity_id, b.grid_t, CASE WHEN b.grid_t - b.t <= a.t - b.grid_t THEN b.event_id ELSE a.event_id END AS event_id,
       CASE WHEN b.grid_t - b.t <= a.t - b.grid_t THEN b.energy ELSE a.energy END AS energy
FROM before b JOIN after a USING (entity_id, grid_t)""",
)
def resample_grid(spark, sf_dir):
    return grid.resample(rows_of(spark, sf_dir), 6 * HOUR, ["energy"])


@query(
    "bucket_max_count",
    f"""WITH {TL}, counts AS (SELECT entity_id, t // {24 * HOUR} AS bucket, label, max(energy) AS m, count(*) AS c FROM tl GROUP BY ALL)
SELECT entity_id, bucket, max(m) AS max_value, sum(c)::BIGINT AS n, string_agg(label || '=' || c, ',' ORDER BY label || '=' || c) AS by_label FROM counts GROUP BY 1, 2""",
)
def bucket_max_count(spark, sf_dir):
    return grid.bucket(rows_of(spark, sf_dir), 24 * HOUR, "energy", "label")


@query(
    "sliding_window_labels",
    f"""WITH {TL}, sizes AS (SELECT entity_id, count(*) AS n FROM tl GROUP BY 1),
starts AS (SELECT entity_id, unnest(range(0, n - 7, 4)) AS window_start FROM sizes WHERE n >= 8
  UNION SELECT entity_id, n - 8 FROM sizes WHERE n >= 8)
SELECT s.entity_id, s.window_start, max(CASE WHEN label = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS has_purchase, sum(energy)::BIGINT AS energy
FROM starts s JOIN tl ON s.entity_id = tl.entity_id AND tl.idx - 1 >= window_start AND tl.idx - 1 < window_start + 8 GROUP BY 1, 2""",
)
def sliding_window_labels(spark, sf_dir):
    wide = grid.sliding(rows_of(spark, sf_dir), 8, 4, aligned_last=True)
    return wide.groupBy(E, "window_start").agg(F.max(F.when(F.col("label") == "purchase", 1).otherwise(0)).alias("has_purchase"), F.sum("energy").alias("energy"))


@query(
    "section_lookup_with_fallback",
    f"""WITH {TL}, {SECTIONS}, lasts AS (SELECT entity_id, max(start_t) AS last_start, max(section) AS last_section FROM sections GROUP BY 1),
found AS (SELECT p.entity_id, p.event_id, p.t, min(s.section) AS section FROM tl p LEFT JOIN sections s ON p.entity_id = s.entity_id AND p.t >= s.start_t AND p.t < s.end_t WHERE p.label = 'purchase' GROUP BY ALL)
SELECT f.entity_id, event_id, coalesce(section, CASE WHEN t >= last_start THEN last_section END) AS section FROM found f JOIN lasts USING (entity_id)""",
)
def section_lookup(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    points = rows.where("label = 'purchase'").select(E, "event_id", "t")
    return joins.containing(points, sections_of(rows), fallback_last=True).select(E, "event_id", F.col("inside.section").alias("section"))


@query(
    "section_lookup_strict",
    f"""WITH {TL}, {SECTIONS}
SELECT p.entity_id, p.event_id, min(s.section) AS section FROM tl p LEFT JOIN sections s ON p.entity_id = s.entity_id AND p.t >= s.start_t AND p.t < s.end_t GROUP BY ALL""",
)
def section_lookup_strict(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    return joins.containing(rows.select(E, "event_id", "t"), sections_of(rows)).select(E, "event_id", F.col("inside.section").alias("section"))


@query(
    "range_members_agg",
    """WITH spans AS (SELECT o_custkey AS entity_id, o_orderkey AS window_id, epoch_us(o_orderdate) AS a, epoch_us(o_orderdate) + 30 * 86400000000::BIGINT AS b FROM orders),
ships AS (SELECT o_custkey AS entity_id, epoch_us(l_shipdate) AS t, l_quantity::BIGINT AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s.entity_id, s.window_id, count(*) AS n, sum(q)::BIGINT AS quantity, max(q) AS peak FROM spans s JOIN ships x ON s.entity_id = x.entity_id AND x.t >= s.a AND x.t < s.b GROUP BY 1, 2""",
)
def range_members_agg(spark, sf_dir):
    day = 24 * HOUR
    us = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {})"
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias(E), F.col("o_orderkey").alias("window_id"), F.expr(us.format("o_orderdate")).alias("start_t"))
    ships = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", F.expr(us.format("l_shipdate")).alias("t"), F.col("l_quantity").cast("long").alias("q"))
    ships = ships.join(orders.select(E, F.col("window_id").alias("l_orderkey")), "l_orderkey").select(E, "t", "q")
    spans = orders.withColumn("end_t", F.col("start_t") + 30 * day)
    pairs = joins.in_range(ships, spans, 30 * day)
    return pairs.groupBy(E, "window_id").agg(F.count("*").alias("n"), F.sum("q").alias("quantity"), F.max("q").alias("peak"))


@query(
    "asof_state",
    f"""WITH {TL}, p AS (SELECT * FROM tl WHERE label = 'purchase'), s AS (SELECT * FROM tl WHERE label = 'signup'),
firsts AS (SELECT entity_id, min_by(event_id, t) AS first_id FROM s GROUP BY 1)
SELECT p.entity_id, p.event_id, coalesce(s.event_id, first_id) AS state_id FROM p ASOF LEFT JOIN s ON p.entity_id = s.entity_id AND p.t >= s.t LEFT JOIN firsts f ON p.entity_id = f.entity_id""",
)
def asof_state(spark, sf_dir):
    points, states = rows_of(spark, sf_dir, "purchase").select(E, "event_id", "t"), rows_of(spark, sf_dir, "signup").select(E, "t", F.col("event_id").alias("state_id"))
    return joins.as_of(points, states, fallback_first=True).select(E, "event_id", F.col("state.state_id").alias("state_id"))


def _nearest_sql(tie: str, limit: str = "") -> str:
    return f"""WITH {TL}, p AS (SELECT * FROM tl WHERE label = 'purchase'), g AS (SELECT entity_id, event_id AS near_id, t AS gt FROM tl WHERE label = 'click'),
ranked AS (SELECT p.entity_id, p.event_id, near_id, p.t - gt AS delta, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(p.t - gt), {tie}) AS r FROM p LEFT JOIN g ON p.entity_id = g.entity_id)
SELECT entity_id, event_id, {f"CASE WHEN abs(delta) <= {limit} THEN near_id END AS near_id" if limit else "near_id"}, delta FROM ranked WHERE r = 1"""


def _nearest(spark, sf_dir, **options):
    points, clicks = rows_of(spark, sf_dir, "purchase").select(E, "event_id", "t"), rows_of(spark, sf_dir, "click").select(E, "t", F.col("event_id").alias("near_id"))
    return joins.nearest(points, clicks, **options).select(E, "event_id", F.col("near.near_id").alias("near_id"), "delta")


@query("nearest_tolerance", _nearest_sql("gt", str(3 * HOUR)))
def nearest_tolerance(spark, sf_dir):
    return _nearest(spark, sf_dir, tolerance=3 * HOUR)


@query("nearest_unlimited", _nearest_sql("gt"))
def nearest_unlimited(spark, sf_dir):
    return _nearest(spark, sf_dir)


@query("nearest_tie_later", _nearest_sql("gt DESC"))
def nearest_tie_later(spark, sf_dir):
    return _nearest(spark, sf_dir, later=True)


def _intervals(spark, sf_dir, side: str, label: str) -> DataFrame:
    return rows_of(spark, sf_dir, label).select(E, F.col("event_id").alias(f"{side}_id"), F.col("t").alias(f"{side}_start"), (F.col("t") + 12 * HOUR).alias(f"{side}_end"), F.col("k").cast("long").alias(f"{side}_label"))


AB = f"""a AS (SELECT entity_id, event_id AS a_id, t AS a_start, t + {12 * HOUR} AS a_end, k AS a_label FROM tl WHERE label = 'click'),
b AS (SELECT entity_id, event_id AS b_id, t AS b_start, t + {12 * HOUR} AS b_end, k AS b_label FROM tl WHERE label = 'view'),
pairs AS (SELECT *, least(a_end, b_end) - greatest(a_start, b_start) AS shared FROM a JOIN b USING (entity_id) WHERE least(a_end, b_end) > greatest(a_start, b_start))"""


@query("overlap_pairs", f"WITH {TL}, {AB} SELECT entity_id, a_id, b_id, shared, shared / greatest(a_end - a_start, b_end - b_start)::DOUBLE AS ratio FROM pairs")
def overlap_pairs(spark, sf_dir):
    pairs = joins.overlapping(_intervals(spark, sf_dir, "a", "click"), _intervals(spark, sf_dir, "b", "view"), 12 * HOUR)
    return pairs.select(E, "a_id", "b_id", "shared", overlap_ratio(F.col("a_start"), F.col("a_end"), F.col("b_start"), F.col("b_end")).alias("ratio"))


@query("overlap_capped", f"WITH {TL}, {AB}, s AS (SELECT a_id, sum(shared)::BIGINT AS s FROM pairs GROUP BY 1) SELECT entity_id, a_id, least(1.0::DOUBLE, coalesce(s, 0) / (a_end - a_start)::DOUBLE) AS score FROM a LEFT JOIN s USING (a_id)")
def overlap_capped(spark, sf_dir):
    return joins.coverage(_intervals(spark, sf_dir, "a", "click"), _intervals(spark, sf_dir, "b", "view"), 12 * HOUR).select(E, "a_id", "score")


@query("overlap_first", f"WITH {TL}, {AB}, f AS (SELECT a_id, min_by(b_id, b_start) AS b_id FROM pairs GROUP BY 1) SELECT entity_id, a_id, b_id FROM a LEFT JOIN f USING (a_id)")
def overlap_first(spark, sf_dir):
    return joins.first_overlap(_intervals(spark, sf_dir, "a", "click"), _intervals(spark, sf_dir, "b", "view"), 12 * HOUR).select(E, "a_id", "b_id")


@query(
    "best_overlap_classify",
    f"""WITH {TL}, {AB}, best AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY shared DESC, b_start, b_id) AS r FROM pairs)
SELECT a.entity_id, a.a_id, best.b_id, coalesce(shared / (a.a_end - a.a_start)::DOUBLE, 0) AS ratio,
  CASE WHEN best.b_id IS NULL THEN 'missing' WHEN shared / (a.a_end - a.a_start)::DOUBLE < 0.5 THEN 'short' WHEN best.b_label <> a.a_label THEN 'differs' ELSE 'match' END AS result
FROM a LEFT JOIN best ON a.a_id = best.a_id AND r = 1""",
)
def best_overlap_classify(spark, sf_dir):
    return joins.best_overlap(_intervals(spark, sf_dir, "a", "click"), _intervals(spark, sf_dir, "b", "view"), 12 * HOUR).select(E, "a_id", "b_id", "ratio", "result")


_NEAR = f"(abs(x.start_t - w.es[w.k].start_t) <= {24 * HOUR} OR abs(x.end_t - w.es[w.k].end_t) <= {24 * HOUR}) AND NOT list_contains(w.used, x.id)"


@query(
    "greedy_match_report",
    f"""WITH RECURSIVE {TL}, iv AS (SELECT entity_id, event_id AS id, label, t AS start_t, t + {6 * HOUR} AS end_t FROM tl WHERE label IN ('purchase', 'signup')),
l AS (SELECT entity_id, list({{'id': id, 'start_t': start_t, 'end_t': end_t}} ORDER BY start_t, id) FILTER (label = 'purchase') AS es, list({{'id': id, 'start_t': start_t, 'end_t': end_t}} ORDER BY start_t, id) FILTER (label = 'signup') AS acs FROM iv GROUP BY 1),
w AS (SELECT entity_id, es, coalesce(acs, []) AS acs, 1 AS k, []::BIGINT[] AS used, NULL::BIGINT AS expected_id, NULL::BIGINT AS actual_id FROM l WHERE es IS NOT NULL UNION ALL
  SELECT entity_id, es, acs, k + 1, CASE WHEN got IS NULL THEN used ELSE list_append(used, got) END, e, got FROM (
    SELECT w.entity_id, w.es, w.acs, w.k, w.used, w.es[w.k].id AS e,
      list_sort(list_transform(list_filter(w.acs, lambda x: {_NEAR}), lambda x: {{'down': -greatest(0, least(x.end_t, w.es[w.k].end_t) - greatest(x.start_t, w.es[w.k].start_t)), 's': x.start_t, 'id': x.id}}))[1].id AS got FROM w WHERE k <= len(es))),
m AS (SELECT entity_id, expected_id, actual_id FROM w WHERE expected_id IS NOT NULL)
SELECT * FROM m UNION ALL SELECT entity_id, NULL, id FROM iv WHERE label = 'signup' AND NOT EXISTS (SELECT 1 FROM m WHERE m.actual_id = iv.id)""",
)
def greedy_match_report(spark, sf_dir):
    """One-to-one matches of purchases and signups within a day."""
    shape = lambda label: rows_of(spark, sf_dir, label).select(E, F.col("event_id").alias("id"), F.lit("x").alias("type"), F.col("t").alias("start_t"), (F.col("t") + 6 * HOUR).alias("end_t"))
    return joins.greedy_matches(shape("purchase"), shape("signup"), 24 * HOUR)


@query(
    "boundary_merge_match",
    f"""WITH RECURSIVE {TL}, l AS (SELECT entity_id, coalesce((list(t ORDER BY t) FILTER (label = 'purchase'))[2:], []) AS a, coalesce((list(t ORDER BY t) FILTER (label = 'signup'))[2:], []) AS b FROM tl GROUP BY 1),
w AS (SELECT entity_id, a, b, 1 AS i, 1 AS j, NULL::VARCHAR AS result, NULL::BIGINT AS reference_t, NULL::BIGINT AS inferred_t FROM l UNION ALL
  SELECT entity_id, a, b, i + CASE WHEN r = 'extra' THEN 0 ELSE 1 END, j + CASE WHEN r = 'missed' THEN 0 ELSE 1 END, r, CASE WHEN r <> 'extra' THEN a[i] END, CASE WHEN r <> 'missed' THEN b[j] END FROM (
    SELECT *, CASE WHEN i <= len(a) AND j <= len(b) AND abs(a[i] - b[j]) <= {24 * HOUR} THEN 'match' WHEN j > len(b) OR (i <= len(a) AND a[i] < b[j]) THEN 'missed' ELSE 'extra' END AS r FROM w WHERE i <= len(a) OR j <= len(b)))
SELECT entity_id, result, reference_t, inferred_t FROM w WHERE result IS NOT NULL""",
)
def boundary_merge_match(spark, sf_dir):
    """Purchases and signups as boundary lists."""
    return joins.match_boundaries(rows_of(spark, sf_dir, "purchase").select(E, "t"), rows_of(spark, sf_dir, "signup").select(E, "t"), 24 * HOUR)


@query("lag_delta", f"WITH {TL} SELECT entity_id, event_id, coalesce(energy - before, 0) AS delta, CASE WHEN idx = 1 THEN 0 WHEN lag(label) OVER (PARTITION BY entity_id ORDER BY idx) IS DISTINCT FROM label THEN 1 ELSE 0 END::BIGINT AS changed FROM tl")
def lag_delta(spark, sf_dir):
    return rows_of(spark, sf_dir).select(E, "event_id", windows.delta("energy").alias("delta"), windows.changed("label").alias("changed"))


@query(
    "rolling_means",
    f"""WITH {TL} SELECT entity_id, event_id, energy::DOUBLE AS local, sum(energy) OVER w16::DOUBLE / count(*) OVER w16 AS phrasal, sum(energy) OVER w128::DOUBLE / count(*) OVER w128 AS structural FROM tl
WINDOW w16 AS (PARTITION BY entity_id ORDER BY idx ROWS 15 PRECEDING), w128 AS (PARTITION BY entity_id ORDER BY idx ROWS 127 PRECEDING)""",
)
def rolling_means(spark, sf_dir):
    return rows_of(spark, sf_dir).select(E, "event_id", *[windows.trailing_mean("energy", n).alias(name) for n, name in ((1, "local"), (16, "phrasal"), (128, "structural"))])


@query(
    "silence_gap",
    f"""WITH {TL}, m AS (SELECT *, sum(CASE WHEN label = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY idx) AS island FROM tl)
SELECT entity_id, event_id, sum(CASE WHEN label = 'purchase' THEN 0 ELSE coalesce(next_t, t) - t END) OVER (PARTITION BY entity_id, island ORDER BY idx)::BIGINT AS gap FROM m""",
)
def silence_gap(spark, sf_dir):
    rows = rows_of(spark, sf_dir).withColumn("_d", F.coalesce(F.lead("t").over(windows.order()), F.col("t")) - F.col("t"))
    return windows.silence(rows, (F.col("label") == "purchase").cast("int"), F.col("_d")).select(E, "event_id", "gap")


@query("local_peaks_radius4", f"WITH {TL}, m AS (SELECT *, max(energy) OVER w AS hi, min(energy) OVER w AS lo FROM tl WINDOW w AS (PARTITION BY entity_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)) SELECT entity_id, event_id, energy = hi AS is_high, energy = lo AS is_low FROM m")
def local_peaks(spark, sf_dir):
    return rows_of(spark, sf_dir).select(E, "event_id", windows.extremum("energy").alias("is_high"), windows.extremum("energy", low=True).alias("is_low"))


SORTED = """sorted AS (SELECT entity_id, list(energy ORDER BY energy) AS v FROM tl GROUP BY 1),
quantiles AS (SELECT entity_id, v[((len(v) - 1) * 9 // 10 + 1)::INT] * (10 - (len(v) - 1) * 9 % 10) + v[least((len(v) - 1) * 9 // 10 + 2, len(v))::INT] * ((len(v) - 1) * 9 % 10) AS q9 FROM sorted)"""


@query(
    "onset_peaks",
    f"""WITH {TL}, {SORTED}, m AS (SELECT *, lead(energy) OVER (PARTITION BY entity_id ORDER BY idx) AS after FROM tl)
SELECT entity_id, event_id, energy FROM m JOIN quantiles USING (entity_id) WHERE energy >= before AND energy > after AND energy * 10 >= q9""",
)
def onset_peaks(spark, sf_dir):
    marked = rows_of(spark, sf_dir).withColumn("_peak", windows.peak("energy"))
    return windows.entity_quantiles(marked, "energy", [9]).where("_peak and energy * 10 >= q9").select(E, "event_id", "energy")


@query(
    "accent_kinds",
    f"""WITH {TL}, {SORTED}, m AS (SELECT *, coalesce(before, energy) AS b, coalesce(lead(energy) OVER (PARTITION BY entity_id ORDER BY idx), energy) AS a FROM tl)
SELECT entity_id, event_id, CASE WHEN energy > b AND energy >= a THEN 'peak' ELSE 'rise' END AS kind FROM m JOIN quantiles USING (entity_id)
WHERE (energy > b AND energy >= a) OR (energy * 10 >= q9 AND energy - b >= 5000)""",
)
def accent_kinds(spark, sf_dir):
    return windows.accents(rows_of(spark, sf_dir), "energy", 5000).where("kind is not null").select(E, "event_id", "kind")


CONTRAST = f"""{TL}, m AS (SELECT *, count(*) OVER l AS nl, count(*) OVER r AS nr, sum(energy) OVER r::DOUBLE / 4 - sum(energy) OVER l::DOUBLE / 4 AS d1, sum(k) OVER r::DOUBLE / 4 - sum(k) OVER l::DOUBLE / 4 AS d2 FROM tl
WINDOW l AS (PARTITION BY entity_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), r AS (PARTITION BY entity_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
c AS (SELECT entity_id, event_id, idx, CASE WHEN nl = 4 AND nr = 4 THEN sqrt(d1 * d1 + d2 * d2) END AS contrast FROM m)"""


@query("boundary_contrast", f"WITH {CONTRAST} SELECT entity_id, event_id, contrast FROM c")
def boundary_contrast(spark, sf_dir):
    return windows.contrast(rows_of(spark, sf_dir), ["energy", "k"]).select(E, "event_id", "contrast")


@query(
    "boundary_refine",
    f"""WITH {CONTRAST}, o AS (SELECT b.entity_id, b.idx, step, contrast - 0.12::DOUBLE * abs(step) AS score FROM (SELECT entity_id, idx FROM tl WHERE (idx - 1) % 8 = 0) b, (SELECT unnest(range(-4, 5)) AS step) s JOIN c ON c.entity_id = b.entity_id AND c.idx = b.idx + step WHERE contrast IS NOT NULL),
r AS (SELECT entity_id, idx, arg_max(step, {{'s': score, 'n': -abs(step), 't': step}}) AS step, max(score) AS top, max(CASE WHEN step = 0 THEN score END) AS own FROM o GROUP BY 1, 2)
SELECT tl.entity_id, tl.idx, tl.idx + CASE WHEN top >= coalesce(own, '-inf'::DOUBLE) + 0.03::DOUBLE THEN step ELSE 0 END AS refined_idx FROM tl JOIN r USING (entity_id, idx) UNION ALL SELECT entity_id, idx, idx FROM tl WHERE (idx - 1) % 8 = 0 AND NOT EXISTS (SELECT 1 FROM r WHERE r.entity_id = tl.entity_id AND r.idx = tl.idx)""",
)
def boundary_refine(spark, sf_dir):
    """Every eighth row as a boundary, moved to the best contrast nearby."""
    rows = windows.contrast(rows_of(spark, sf_dir), ["energy", "k"])
    return windows.refine(rows, rows.where("(idx - 1) % 8 = 0").select(E, "idx"))


RUNS = "marked AS (SELECT *, CASE WHEN lag(label) OVER (PARTITION BY entity_id ORDER BY idx) IS NOT DISTINCT FROM label THEN 0 ELSE 1 END AS new FROM tl), islands AS (SELECT *, sum(new) OVER (PARTITION BY entity_id ORDER BY idx) - 1 AS run FROM marked)"


@query(
    "runs_rle",
    f"""WITH {TL}, {RUNS}, grouped AS (SELECT entity_id, run::BIGINT AS run, min(label) AS label, min(idx) AS first_idx, max(idx) AS last_idx, min(t) AS start_t, count(*) AS n_rows, sum(energy)::BIGINT AS energy_sum FROM islands GROUP BY 1, 2),
lasts AS (SELECT entity_id, max(t) AS last_t FROM tl GROUP BY 1)
SELECT entity_id, run, label, first_idx, last_idx, start_t, n_rows, energy_sum, coalesce(lead(start_t) OVER (PARTITION BY entity_id ORDER BY run), last_t) AS end_t FROM grouped JOIN lasts USING (entity_id)""",
)
def runs_rle(spark, sf_dir):
    return sequences.runs(rows_of(spark, sf_dir), "label", ["energy"])


@query(
    "merge_equal_events",
    f"""WITH {TL}, {RUNS}, lists AS (SELECT entity_id, run, min(label) AS label, min(t) AS start_t, max(coalesce(next_t, t)) AS end_t, list(energy::DOUBLE ORDER BY t) AS c FROM islands GROUP BY 1, 2)
SELECT entity_id, label, start_t, end_t, list_reduce(c, lambda s, x: (s + x) / 2) AS confidence FROM lists""",
)
def merge_equal_events(spark, sf_dir):
    end = F.coalesce(F.lead("t").over(windows.order()), F.col("t"))
    events = rows_of(spark, sf_dir).select(E, "label", F.col("t").alias("start_t"), end.alias("end_t"), F.col("energy").cast("double").alias("confidence"))
    return sequences.merge_equal(events)


@query(
    "anchor_islands",
    f"""WITH {TL}, hits AS (SELECT *, idx - row_number() OVER (PARTITION BY entity_id ORDER BY idx) AS g FROM tl WHERE energy >= 5000)
SELECT entity_id, min(idx) AS first_idx, max(idx) AS last_idx, min(t) AS start_t, max(t) AS last_t, count(*) AS n_rows FROM hits GROUP BY entity_id, g""",
)
def anchor_islands(spark, sf_dir):
    return sequences.islands(rows_of(spark, sf_dir).where("energy >= 5000"))


def _cooldown_sql(source: str, gap: int, compare: str) -> str:
    return f"""WITH RECURSIVE {TL}, hits AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY t, event_id) AS n FROM ({source})),
walk AS (SELECT entity_id, event_id, t, n, t AS last_t, true AS kept FROM hits WHERE n = 1
  UNION ALL SELECT h.entity_id, h.event_id, h.t, h.n, CASE WHEN h.t - w.last_t {compare} {gap} THEN h.t ELSE w.last_t END, h.t - w.last_t {compare} {gap} FROM walk w JOIN hits h ON h.entity_id = w.entity_id AND h.n = w.n + 1)
SELECT entity_id, event_id, t FROM walk WHERE kept"""


@query("cooldown_accents", _cooldown_sql("SELECT * FROM tl WHERE energy >= 3000", 24 * HOUR, ">="))
def cooldown_accents(spark, sf_dir):
    return sequences.cooldown(rows_of(spark, sf_dir).where("energy >= 3000"), 24 * HOUR).select(E, "event_id", "t")


@query("identifier_drop", _cooldown_sql("SELECT * FROM tl WHERE energy - before > 2500", 48 * HOUR, ">"))
def identifier_drop(spark, sf_dir):
    """Rises of energy, each more than the cooldown after the last kept."""
    rising = rows_of(spark, sf_dir).withColumn("_d", windows.delta("energy")).where("_d > 2500")
    return sequences.cooldown(rising, 48 * HOUR, strict=True).select(E, "event_id", "t")


@query(
    "micro_patterns",
    f"""WITH {TL}, grams AS (SELECT entity_id, idx, label || '>' || lead(label) OVER w || '>' || lead(label, 2) OVER w AS pattern FROM tl WINDOW w AS (PARTITION BY entity_id ORDER BY idx))
SELECT entity_id, pattern, count(*) AS n, min(idx) AS first_idx FROM grams WHERE pattern IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3""",
)
def micro_patterns(spark, sf_dir):
    return sequences.ngrams(rows_of(spark, sf_dir), 3, 3)


@query("pattern_miner")
def pattern_miner(spark, sf_dir):
    """Repeated bar sequences per user; order-dependent, tested by invariants."""
    rows = rows_of(spark, sf_dir).withColumn("label", F.when(F.col("label").isin("click", "view"), "A").otherwise("B"))
    return sequences.mine_patterns(sequences.bar_labels(rows))


@query("bar_unit", f"WITH {TL}, bars AS (SELECT entity_id, bar, list(label ORDER BY beat_in_bar) AS beats FROM tl GROUP BY ALL HAVING count(*) = 4) SELECT entity_id, bar, CASE WHEN beats[1] = beats[2] AND beats[2] = beats[3] AND beats[3] = beats[4] THEN 1 WHEN beats[1] = beats[3] AND beats[2] = beats[4] THEN 2 ELSE 4 END::BIGINT AS unit FROM bars")
def bar_unit(spark, sf_dir):
    return sequences.bar_labels(rows_of(spark, sf_dir)).select(E, "bar", sequences.repeating_unit(F.col("beats")).alias("unit"))


@query("short_runs_absorbed")
def short_runs_absorbed(spark, sf_dir):
    return sequences.absorb_short_runs(rows_of(spark, sf_dir))


@query("viterbi_labels")
def viterbi_labels(spark, sf_dir):
    return sequences.viterbi(rows_of(spark, sf_dir), ["click", "login", "purchase", "signup", "view"])


@query("distinct_notes")
def distinct_notes(spark, sf_dir):
    notes = rows_of(spark, sf_dir).select(E, "event_id", "t", (F.col("k") % 12).alias("pitch"), F.when(F.col("label") == "click", 0).otherwise(1).alias("priority"), F.col("energy").alias("confidence"))
    return sequences.distinct_notes(notes, 24 * HOUR)


@query("phrase_prototypes")
def phrase_prototypes(spark, sf_dir):
    """Counts of labels per bar as vectors, grouped by running-mean prototypes."""
    kinds = ["click", "login", "purchase", "signup", "view"]
    bars = rows_of(spark, sf_dir).groupBy(E, F.col("bar").alias("idx")).agg(F.array(*[F.count_if(F.col("label") == k).cast("double") for k in kinds]).alias("vector"))
    return sequences.prototypes(bars)


DAYS = "days AS (SELECT *, t // 86400000000 AS day FROM tl)"


@query(
    "dominant_label",
    f"""WITH {TL}, {DAYS}, c AS (SELECT entity_id, day, label, count(*) AS n, sum(energy)::BIGINT AS w FROM days GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY entity_id, day ORDER BY n DESC, w DESC, label) AS r FROM c) SELECT entity_id, day, label, n, w FROM r WHERE r = 1""",
)
def dominant_label(spark, sf_dir):
    return features.dominant(rows_of(spark, sf_dir).withColumn("day", F.floor(F.col("t") / (24 * HOUR))), ["day"])


@query(
    "section_mode",
    f"""WITH {TL}, {DAYS}, c AS (SELECT entity_id, day, label, count(*) AS n, min(idx) AS f FROM days GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY entity_id, day ORDER BY n DESC, f) AS r FROM c) SELECT entity_id, day, label, n FROM r WHERE r = 1""",
)
def section_mode(spark, sf_dir):
    return features.most_common(rows_of(spark, sf_dir).withColumn("day", F.floor(F.col("t") / (24 * HOUR))), ["day"])


STATS = """stats AS (SELECT entity_id, count(*) AS n, sum(energy)::BIGINT AS s, sum(energy * energy)::BIGINT AS q, min(energy) AS low, max(energy) AS high FROM tl GROUP BY 1)"""


@query("song_statistics", f"WITH {TL}, {STATS} SELECT entity_id, n, s / n::DOUBLE AS mean, sqrt((n * q - s * s)::DOUBLE) / n AS deviation, CASE WHEN n > 1 THEN sqrt((n * q - s * s)::DOUBLE) / sqrt((n * (n - 1))::DOUBLE) END AS sample_deviation, low, high FROM stats")
def song_statistics(spark, sf_dir):
    return features.statistics(rows_of(spark, sf_dir), "energy")


@query(
    "zscore_features",
    f"""WITH {TL}, {STATS} SELECT entity_id, event_id, (energy - s / n::DOUBLE) / (sqrt((n * q - s * s)::DOUBLE) / n) AS z, CASE WHEN high - low < 1e-8 THEN 0 ELSE (energy - low)::DOUBLE / (high - low) END AS scaled,
CASE WHEN high <= 1e-12 THEN 0 ELSE energy / high::DOUBLE END AS share, 0.25 + (energy - low)::DOUBLE / (high - low) * 0.5 AS banded FROM tl JOIN stats USING (entity_id)""",
)
def zscore_features(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    joined = rows.join(features.statistics(rows, "energy"), E)
    x = F.col("energy")
    return joined.select(E, "event_id", z_score(x, F.col("mean"), F.col("deviation")).alias("z"), min_max(x, E).alias("scaled"), max_scale(x, E).alias("share"), scale_into(x, F.col("low"), F.col("high"), 0.25, 0.75).alias("banded"))


@query("quantile_levels", f"WITH {TL}, q AS (SELECT entity_id, quantile_cont(energy, 0.25) AS a, quantile_cont(energy, 0.75) AS b FROM tl GROUP BY 1) SELECT entity_id, event_id, CASE WHEN energy >= b THEN 'high' WHEN energy >= a THEN 'medium' ELSE 'low' END AS level FROM tl JOIN q USING (entity_id)")
def quantile_levels(spark, sf_dir):
    return features.levels(rows_of(spark, sf_dir), "energy", 0.25, 0.75).select(E, "event_id", "level")


@query(
    "trend_labels",
    f"""WITH {TL}, g AS (SELECT entity_id, (idx - 1) // 16 AS section, list(energy ORDER BY idx) AS v FROM tl GROUP BY ALL),
c AS (SELECT *, len(v) AS n, greatest(len(v) // 3, 1) AS third, list_sum(v[1:greatest(len(v) // 3, 1)])::BIGINT AS f, list_sum(v[len(v) - greatest(len(v) // 3, 1) + 1:])::BIGINT AS l FROM g)
SELECT entity_id, section, n, CASE WHEN l - f >= 1500 * third THEN 'build' WHEN l - f <= -1500 * third THEN 'release' WHEN list_max(v) - list_min(v) <= 1500 THEN 'plateau' ELSE 'wave' END AS trend FROM c""",
)
def trend_labels(spark, sf_dir):
    return features.trends(rows_of(spark, sf_dir).withColumn("section", F.floor((F.col("idx") - 1) / 16)), ["section"], "energy", 1500)


@query("energy_clusters")
def energy_clusters(spark, sf_dir):
    """Clusters of energy and k per user; no oracle, as starts differ."""
    return features.energy_clusters(rows_of(spark, sf_dir), ["energy", "k"])


@query(
    "cue_anchors",
    f"""WITH {TL}, u AS (SELECT entity_id, 'purchase' AS kind, t, event_id AS source_id FROM tl WHERE label = 'purchase' UNION ALL SELECT entity_id, 'signup', t, event_id FROM tl WHERE label = 'signup' UNION ALL SELECT entity_id, 'accent', t, event_id FROM tl WHERE energy >= 9000)
SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY t, kind, source_id) AS number FROM u""",
)
def cue_anchors(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    return layers.anchors({"purchase": rows.where("label = 'purchase'"), "signup": rows.where("label = 'signup'"), "accent": rows.where("energy >= 9000")})


@query("pattern_callbacks", f"WITH {TL} SELECT entity_id, event_id, row_number() OVER w AS occurrence, CASE WHEN row_number() OVER w = 1 THEN 'establish' ELSE 'repeat' END AS action FROM tl WINDOW w AS (PARTITION BY entity_id, label ORDER BY t, event_id)")
def pattern_callbacks(spark, sf_dir):
    return layers.callbacks(rows_of(spark, sf_dir), pattern="label", start="t").select(E, "event_id", "occurrence", "action")


@query(
    "section_cards",
    f"""WITH {TL}, {SECTIONS}, j AS (SELECT tl.entity_id, s.section, energy FROM tl JOIN sections s ON tl.entity_id = s.entity_id AND t >= start_t AND t < end_t),
g AS (SELECT entity_id, section, count(*) AS n, sum(energy)::BIGINT / count(*)::DOUBLE AS mean, max(energy) AS peak FROM j GROUP BY 1, 2)
SELECT *, coalesce(mean - lag(mean) OVER (PARTITION BY entity_id ORDER BY section), 0) AS change FROM g""",
)
def section_cards(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    return layers.section_cards(rows, sections_of(rows))


@query(
    "accents_in_sections",
    f"""WITH {TL}, {SECTIONS}, p AS (SELECT s.entity_id, s.section AS window_id, event_id, row_number() OVER (PARTITION BY s.entity_id, s.section ORDER BY t, event_id) AS r FROM tl JOIN sections s ON tl.entity_id = s.entity_id AND t >= start_t AND t <= end_t WHERE energy >= 4000)
SELECT entity_id, window_id, string_agg(event_id::VARCHAR, ',' ORDER BY r) AS accents FROM p WHERE r <= 6 GROUP BY 1, 2""",
)
def accents_in_sections(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    found = layers.accents_in(sections_of(rows).withColumnRenamed("section", "window_id"), rows.where("energy >= 4000").select(E, "t", "event_id"), 24 * HOUR)
    return found.select(E, "window_id", F.array_join(F.transform("accents", lambda x: x.cast("string")), ",").alias("accents"))


@query("event_numbers", f"WITH {TL} SELECT entity_id, event_id, label || '_' || CASE WHEN row_number() OVER w < 1000 THEN lpad((row_number() OVER w)::VARCHAR, 3, '0') ELSE substr((row_number() OVER w)::VARCHAR, 1, 3) END AS number_id FROM tl WINDOW w AS (PARTITION BY entity_id, label ORDER BY t, event_id)")
def event_numbers(spark, sf_dir):
    return windows.numbered(rows_of(spark, sf_dir), ["label"]).select(E, "event_id", "number_id")


@query("point_gaps", f"WITH {TL}, g AS (SELECT entity_id, t - lag(t) OVER (PARTITION BY entity_id ORDER BY idx) AS gap FROM tl) SELECT entity_id, median(gap)::DOUBLE AS median_gap, max(gap) AS longest FROM g WHERE gap > 0 GROUP BY 1")
def point_gaps(spark, sf_dir):
    gaps = rows_of(spark, sf_dir).withColumn("gap", F.col("t") - F.lag("t").over(windows.order())).where("gap > 0")
    return gaps.groupBy(E).agg(F.median("gap").alias("median_gap"), F.max("gap").alias("longest"))
