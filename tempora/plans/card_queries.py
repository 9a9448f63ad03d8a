"""Queries of grids, vectors, names and cards, over the timeline proxy."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import PITCH_CLASSES
from ..operators import cards, reports
from .feature_queries import DAY, beats_of, tracks_of
from .registry import HOUR, TL, query
from .timeline_queries import E, rows_of

SOURCES = ["click", "view", "purchase", "signup", "error"]
EN = f"{TL}, en AS (SELECT * REPLACE (coalesce(k, 0) AS k), coalesce(next_t, t) AS end_t FROM tl)"
MINUTE = HOUR // 60


@query(
    "reference_grid",
    f"""WITH {EN}, f AS (SELECT entity_id, t // {HOUR} * {HOUR} AS t, arg_min(CASE WHEN k % 3 = 0 THEN 0 ELSE bar END, event_id) AS bar, arg_min(CASE WHEN k % 4 = 0 THEN NULL ELSE beat_in_bar END, event_id) AS b0, arg_min(coalesce(CASE WHEN k % 4 = 0 THEN NULL ELSE beat_in_bar END, 0), event_id) AS beat FROM en GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER w AS idx, greatest(lead(t) OVER w - t, 1) AS gap FROM f WINDOW w AS (PARTITION BY entity_id ORDER BY t)),
g AS (SELECT entity_id, t, idx, CASE WHEN bar = 0 THEN (idx - 1) // 4 + 1 ELSE bar END AS bar, CASE WHEN beat = 0 THEN (idx - 1) % 4 + 1 ELSE beat END AS beat_in_bar FROM p), m AS (SELECT entity_id, 60000000::DOUBLE / median(gap) AS tempo FROM p GROUP BY 1)
SELECT g.*, coalesce(lag(bar) OVER (PARTITION BY g.entity_id ORDER BY t) <> bar, true) AS bar_start, tempo FROM g JOIN m USING (entity_id)""",
)
def reference_grid(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    made = rows.select(E, "event_id", (F.floor(F.col("t") / HOUR) * HOUR).alias("t"), F.when(F.col("k") % 3 == 0, 0).otherwise(F.col("bar")).alias("bar"), F.when(F.col("k") % 4 != 0, F.col("beat_in_bar")).alias("beat_in_bar"))
    return cards.reference_grid(made)


def _frames(width: int) -> str:
    labels = ", ".join(f"coalesce(max(CASE WHEN label = '{s}' THEN v END), 0)" for s in SOURCES)
    return f"""WITH {EN}, sp AS (SELECT entity_id, min(t) AS a, max(t) AS b FROM en GROUP BY 1), pw AS (SELECT entity_id, label, (t - a) // {width} AS frame, sqrt(sum(energy * energy)::BIGINT / count(*)) AS rms FROM en JOIN sp USING (entity_id) GROUP BY 1, 2, 3),
sc AS (SELECT *, rms / max(rms) OVER (PARTITION BY entity_id, label) AS v FROM pw), gr AS (SELECT entity_id, unnest(range(greatest(1, ceil((b - a) / {width}::DOUBLE)::BIGINT))) AS frame FROM sp)
SELECT gr.entity_id, gr.frame, [{labels}] AS levels FROM gr LEFT JOIN sc USING (entity_id, frame) GROUP BY 1, 2"""


@query("loudness_fine", _frames(6 * HOUR))
def loudness_fine(spark, sf_dir):
    return cards.loudness_frames(rows_of(spark, sf_dir), 6 * HOUR, SOURCES)


@query("loudness_coarse", _frames(5 * DAY))
def loudness_coarse(spark, sf_dir):
    return cards.loudness_frames(rows_of(spark, sf_dir), 5 * DAY, SOURCES)


@query(
    "beat_vectors",
    f"""WITH {EN}, m AS (SELECT entity_id, bar, sum(energy)::BIGINT / count(*)::DOUBLE AS a, sum(k)::BIGINT / count(*)::DOUBLE AS b, sum(idx)::BIGINT / count(*)::DOUBLE AS c, sqrt(sum(energy * energy)::BIGINT / count(*)::DOUBLE) AS rms FROM en GROUP BY 1, 2),
l AS (SELECT *, sqrt(a * a + b * b + c * c) AS l FROM m) SELECT entity_id, bar, [a / l, b / l, c / l] AS vector, rms / max(rms) OVER (PARTITION BY entity_id) AS activity FROM l""",
)
def beat_vectors(spark, sf_dir):
    return cards.unit_mean(beats_of(spark, sf_dir), ["bar"], ["energy", "k", "idx"])


_BINS = ", ".join(f"coalesce(sum(CASE WHEN k % 12 = {i} THEN end_t - t END), 0)::BIGINT / sum(end_t - t)::BIGINT::DOUBLE" for i in range(12))


@query("bar_vectors", f"WITH {EN} SELECT entity_id, bar, [sum(energy)::BIGINT / count(*)::DOUBLE, sum(k)::BIGINT / count(*)::DOUBLE, {', '.join('CASE WHEN sum(end_t - t) > 0 THEN ' + b + ' ELSE 0 END' for b in _BINS.split(', coalesce')[:1])}{''.join(', CASE WHEN sum(end_t - t) > 0 THEN coalesce' + b + ' ELSE 0 END' for b in _BINS.split(', coalesce')[1:])}] AS vector FROM en GROUP BY 1, 2")
def bar_vectors(spark, sf_dir):
    rows = beats_of(spark, sf_dir).withColumns({"root": F.col("k") % 12, "length": F.col("end_t") - F.col("t")})
    return cards.root_histogram(rows, ["bar"], ["energy", "k"])


@query("beat_one_hot", f"WITH {EN} SELECT event_id, list_concat([energy::DOUBLE], [{', '.join(f'CASE WHEN k % 12 = {i} THEN 1::DOUBLE ELSE 0::DOUBLE END' for i in range(12))}]) AS vector FROM en")
def beat_one_hot(spark, sf_dir):
    return beats_of(spark, sf_dir).select("event_id", F.concat(F.array(F.col("energy").cast("double")), cards.one_hot((F.col("k") % 12).cast("int"))).alias("vector"))


@query(
    "timeline_index",
    f"""WITH {EN} SELECT entity_id, 'beats' AS kind, idx::VARCHAR AS id, t AS start_t, end_t FROM en UNION ALL SELECT entity_id, 'sections', ((idx - 1) // 8)::VARCHAR, min(t), max(t) FROM en GROUP BY entity_id, (idx - 1) // 8
UNION ALL SELECT entity_id, 'phrases', ((idx - 1) // 4)::VARCHAR, min(t), max(t) FROM en WHERE (idx - 1) // 4 % 3 <> 2 GROUP BY entity_id, (idx - 1) // 4 UNION ALL SELECT entity_id, 'chords', label, t, lead(t, 1, t) OVER (PARTITION BY entity_id ORDER BY idx) FROM en WHERE idx % 4 = 1
UNION ALL SELECT entity_id, 'accents', event_id::VARCHAR, t + k * {MINUTE}, t + k * {MINUTE} FROM en WHERE label = 'purchase'""",
)
def timeline_index(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    tracks, c = tracks_of(rows), F.col
    return cards.timeline_index({"beats": (rows, c("idx"), c("t"), c("end_t")), "sections": (tracks.sections, c("section"), c("start_t"), c("end_t")), "phrases": (tracks.phrases, c("phrase"), c("start_t"), c("end_t")), "chords": (tracks.chords, c("chord"), c("start_t"), c("end_t")), "accents": (tracks.accents, c("accent_id"), c("at"), c("at"))})


_BARS = "ba AS (SELECT entity_id, bar, min(t) AS start_t, max(t) AS end_t, CASE WHEN bar <= 9 THEN 0 WHEN bar <= 14 THEN 1 ELSE 2 END AS section FROM en GROUP BY 1, 2)"


def bars_in_sections(spark, sf_dir):
    """Bars in sections of nine, five and all others."""
    section = F.when(F.col("bar") <= 9, 0).when(F.col("bar") <= 14, 1).otherwise(2)
    return rows_of(spark, sf_dir).groupBy(E, "bar").agg(F.min("t").alias("start_t"), F.max("t").alias("end_t")).withColumn("section", section)


@query("phrase_windows", f"WITH {EN}, {_BARS}, c AS (SELECT *, row_number() OVER (PARTITION BY entity_id, section ORDER BY bar) - 1 AS i, count(*) OVER (PARTITION BY entity_id, section) AS n FROM ba) SELECT entity_id, section, i // CASE WHEN n >= 8 THEN 4 WHEN n >= 4 THEN 2 ELSE n END AS \"window\", min(bar) AS start_bar, max(bar) AS end_bar, min(start_t) AS start_t, arg_max(end_t, bar) AS end_t, count(*) AS bar_count FROM c GROUP BY 1, 2, 3")
def phrase_windows(spark, sf_dir):
    return cards.phrase_windows(bars_in_sections(spark, sf_dir))


@query("source_buckets", f"WITH {EN} SELECT entity_id, label, t // {DAY} AS bucket, least(1::DOUBLE, sum(energy)::BIGINT / count(*)::DOUBLE / 20000::DOUBLE) AS mean_level, least(1::DOUBLE, max(energy) / 20000::DOUBLE) AS max_level FROM en GROUP BY 1, 2, 3")
def source_buckets(spark, sf_dir):
    capped = lambda x: F.least(F.lit(1.0), x / F.lit(20000.0))
    return rows_of(spark, sf_dir).groupBy(E, "label", F.floor(F.col("t") / DAY).alias("bucket")).agg(capped(F.sum("energy") / F.count("*")).alias("mean_level"), capped(F.max("energy")).alias("max_level"))


@query("spectral_flux", f"WITH {EN}, s AS (SELECT event_id, entity_id, idx, CASE WHEN energy + k + idx > 0 THEN energy / (energy + k + idx)::DOUBLE ELSE 0 END AS a, CASE WHEN energy + k + idx > 0 THEN k / (energy + k + idx)::DOUBLE ELSE 0 END AS b, CASE WHEN energy + k + idx > 0 THEN idx / (energy + k + idx)::DOUBLE ELSE 0 END AS c FROM en), d AS (SELECT event_id, a - lag(a) OVER w AS x, b - lag(b) OVER w AS y, c - lag(c) OVER w AS z FROM s WINDOW w AS (PARTITION BY entity_id ORDER BY idx)) SELECT event_id, coalesce(sqrt(x * x + y * y + z * z), 0) AS flux FROM d")
def spectral_flux(spark, sf_dir):
    return cards.spectral_flux(beats_of(spark, sf_dir), ["energy", "k", "idx"]).select("event_id", "flux")


@query("edge_medians", f"WITH {EN}, w AS (SELECT entity_id, energy - 9000 AS delta, row_number() OVER (PARTITION BY entity_id ORDER BY idx) AS i, count(*) OVER (PARTITION BY entity_id) AS n FROM en WHERE label <> 'view'), s AS (SELECT *, CASE WHEN n <= 6 THEN greatest(2, n // 2) ELSE greatest(3, least(16, n // 4)) END AS size FROM w) SELECT entity_id, max(size) AS window_size, median(CASE WHEN i <= size THEN delta END) AS start_median, median(CASE WHEN i > n - size THEN delta END) AS end_median FROM s GROUP BY 1")
def edge_medians(spark, sf_dir):
    return cards.edge_medians(rows_of(spark, sf_dir).where("label <> 'view'").withColumn("delta", F.col("energy") - 9000))


def _novelty(values: list[str]) -> str:
    frame = "OVER (PARTITION BY entity_id ORDER BY idx ROWS BETWEEN {})"
    a = [f"(sum({v}) {frame.format('2 PRECEDING AND 1 PRECEDING')})::DOUBLE" for v in values]
    b = [f"(sum({v}) {frame.format('CURRENT ROW AND 1 FOLLOWING')})::DOUBLE" for v in values]
    dot = lambda x, y: " + ".join(f"{p} * {q}" for p, q in zip(x, y))
    size = f"(sqrt({dot(a, a)}) * sqrt({dot(b, b)}))"
    return f"(1 - CASE WHEN {size} > 0 THEN ({dot(a, b)}) / {size} ELSE 0 END)"


@query(
    "shifted_boundaries",
    f"""WITH {EN}, s AS (SELECT entity_id, idx, count(*) OVER (PARTITION BY entity_id) AS n, round({_novelty(['energy', 'k * 90', 'idx * 40'])} * 0.5::DOUBLE + {_novelty(['k', 'beat_in_bar * 9'])} * 0.35::DOUBLE + (1 - k / 100::DOUBLE) * 0.15::DOUBLE, 9) AS score FROM en),
o AS (SELECT entity_id, idx, idx + step AS at_ FROM en, (SELECT unnest([-1, 0, 1]) AS step) WHERE idx % 4 = 1), m AS (SELECT o.entity_id, o.idx, at_, score, row_number() OVER (PARTITION BY o.entity_id, o.idx ORDER BY score DESC, at_) AS rn FROM o JOIN s ON s.entity_id = o.entity_id AND s.idx = at_ AND s.idx > 1 AND s.idx < n)
SELECT en.entity_id, en.idx, coalesce(at_, en.idx) AS moved_idx FROM en LEFT JOIN m ON m.entity_id = en.entity_id AND m.idx = en.idx AND rn = 1 WHERE en.idx % 4 = 1""",
)
def shifted_boundaries(spark, sf_dir):
    rows = beats_of(spark, sf_dir).withColumns({"k90": F.col("k") * 90, "i40": F.col("idx") * 40, "b9": F.col("beat_in_bar") * 9, "quiet": F.col("k") / F.lit(100.0)})
    return cards.shifted_boundaries(rows, rows.where("idx % 4 = 1").select(E, "idx"), ["energy", "k90", "i40"], ["k", "b9"], "quiet")


@query("majority_positions", f"WITH {EN}, c AS (SELECT entity_id, (bar - 1) % 3 AS grp, beat_in_bar, label, count(*) AS n, min(bar) AS first FROM en GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY entity_id, grp, beat_in_bar ORDER BY n DESC, first) AS rn FROM c) SELECT entity_id, grp, beat_in_bar, label FROM r WHERE rn = 1")
def majority_positions(spark, sf_dir):
    rows = rows_of(spark, sf_dir).withColumn("grp", (F.col("bar") - 1) % 3)
    return cards.majority_positions(rows, ["grp"], "beat_in_bar", "label", ["bar"])


@query(
    "display_forms",
    f"""WITH {EN}, l AS (SELECT entity_id, bar, list(CASE WHEN k % 9 = 0 THEN NULL ELSE label END ORDER BY idx) AS labels FROM en GROUP BY 1, 2), f AS (SELECT entity_id, bar, list_transform(labels, lambda x: coalesce(x, 'N')) AS labels FROM l),
r AS (SELECT *, list_transform(range(1, len(labels) + 1), lambda i: i = 1 OR labels[i] <> labels[i - 1]) AS head, list_transform(range(1, len(labels) + 1), lambda i: (i > 1 AND labels[i] = labels[i - 1]) OR (i < len(labels) AND labels[i] = labels[i + 1])) AS lng FROM f)
SELECT entity_id, bar, list_aggregate(list_filter(labels, lambda x, i: head[i]), 'string_agg', '-') AS display, list_aggregate(list_transform(labels, lambda x, i: CASE WHEN NOT head[i] THEN '' WHEN i = 1 THEN x ELSE CASE WHEN lng[i - 1] OR lng[i] THEN '→' ELSE '|' END || x END), 'string_agg', '') AS runs FROM r""",
)
def display_forms(spark, sf_dir):
    rows = beats_of(spark, sf_dir).withColumn("label", F.when(F.col("k") % 9 != 0, F.col("label")))
    lists = rows.groupBy(E, "bar").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "label"))), lambda x: x["label"]).alias("_l"))
    filled = F.transform("_l", lambda x: F.coalesce(x, F.lit("N")))
    return lists.select(E, "bar", cards.display_bar(F.col("_l")).alias("display"), F.col("_l")).withColumn("_f", filled).withColumn("runs", cards.display_runs(F.col("_f"))).drop("_l", "_f")


_MOTIFS = "[" + ", ".join(f"'{m}'" for m in cards.MOTIFS) + "]"


@query(
    "named_groups",
    f"""WITH {EN}, {_BARS}, w AS (SELECT *, (bar * 7 + entity_id) % 5 AS grp FROM ba), s AS (SELECT entity_id, grp, count(*) AS n, min(start_t) AS f FROM w GROUP BY 1, 2), g AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, f) - 1 AS g FROM s),
c AS (SELECT entity_id, grp, n, 'phrase_group_' || chr((65 + g)::INT) AS phrase_group_id, 'motif_' || {_MOTIFS}[g + 1] AS motif_id FROM g)
SELECT w.*, n, phrase_group_id, motif_id, phrase_group_id || '_' || row_number() OVER (PARTITION BY w.entity_id, w.grp ORDER BY start_t) AS window_id FROM w JOIN c USING (entity_id, grp)""",
)
def named_groups(spark, sf_dir):
    return cards.named_groups(bars_in_sections(spark, sf_dir).withColumn("grp", (F.col("bar") * 7 + F.col(E)) % 5))


def _chord_sql(root: str) -> str:
    names = "[" + ", ".join(f"'{p}'" for p in PITCH_CLASSES) + "]"
    case = lambda steps: "CASE " + " ".join(f"WHEN ({root} - tonic + 12) % 12 = {s} THEN {names}[{root} + 1] || '{e}'" for s, e in steps) + " END"
    return f"CASE WHEN major THEN {case(cards.MAJOR)} ELSE {case(cards.MINOR)} END"


_SUMS = ", ".join(f"sum((energy * {i + 3} + k * {i * 5 + 1}) % 1000)::BIGINT / count(*)::DOUBLE AS c{i}" for i in range(12))
_LIST = "[" + ", ".join(f"{{'v': c{i}, 'i': {i}}}" for i in range(12)) + "]"


@query(
    "corrected_chords",
    f"""WITH {EN}, ch AS (SELECT entity_id, idx, label AS chord, t AS start_t, lead(t, 1, t) OVER (PARTITION BY entity_id ORDER BY idx) AS end_t, entity_id % 12 AS tonic, entity_id % 2 = 0 AS major FROM en WHERE idx % 4 = 1),
m AS (SELECT ch.entity_id, ch.idx, chord, tonic, major, {_SUMS} FROM ch JOIN en x ON x.entity_id = ch.entity_id AND x.t >= ch.start_t AND x.t < ch.end_t GROUP BY ALL), r AS (SELECT *, list_reverse_sort({_LIST}) AS c FROM m),
k AS (SELECT entity_id, idx, CASE WHEN c[1].v - c[2].v >= 40 THEN coalesce({_chord_sql('c[1].i')}, chord) ELSE chord END AS corrected FROM r)
SELECT ch.entity_id, ch.idx, coalesce(corrected, chord) AS corrected FROM ch LEFT JOIN k USING (entity_id, idx)""",
)
def corrected_chords(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    w = Window.partitionBy(E).orderBy("idx")
    chords = rows.where("idx % 4 = 1").select(E, "idx", F.col("label").alias("chord"), F.col("t").alias("start_t"), F.coalesce(F.lead("t").over(w), F.col("t")).alias("end_t"), (F.col(E) % 12).alias("tonic"), (F.col(E) % 2 == 0).alias("major"))
    chroma = rows.select(E, "t", *[((F.col("energy") * (i + 3) + F.col("k") * (i * 5 + 1)) % 1000).alias(f"c{i}") for i in range(12)])
    return cards.corrected_chords(chords, chroma, DAY, "idx", 40).select(E, "idx", "corrected")


@query(
    "aligned_notes",
    f"""WITH {EN}, {_BARS}, no AS (SELECT entity_id, event_id, t + (k - 30) * {10 * MINUTE} AS t FROM en WHERE label = 'click'), be AS (SELECT * FROM en WHERE label <> 'click'), sec AS (SELECT entity_id, section, min(start_t) AS s, max(end_t) AS e FROM ba GROUP BY 1, 2), sl AS (SELECT entity_id, max(s) AS s, max(section) AS section FROM sec GROUP BY 1),
nb AS (SELECT no.entity_id, no.event_id, no.t, be.idx, be.bar, no.t - be.t AS delta, row_number() OVER (PARTITION BY no.event_id ORDER BY abs(no.t - be.t), be.t) AS rn FROM no JOIN be USING (entity_id)),
n1 AS (SELECT no.*, idx, bar, delta, coalesce(abs(delta) <= {3 * HOUR}, false) AS resolved FROM no LEFT JOIN nb ON nb.event_id = no.event_id AND rn = 1),
n2 AS (SELECT n1.*, ba.bar AS inside FROM n1 LEFT JOIN ba ON ba.entity_id = n1.entity_id AND n1.t >= ba.start_t AND n1.t < ba.end_t), n3 AS (SELECT n2.*, sec.section AS sect FROM n2 LEFT JOIN sec ON sec.entity_id = n2.entity_id AND n2.t >= sec.s AND n2.t < sec.e)
SELECT event_id, CASE WHEN resolved THEN idx END AS aligned_idx, coalesce(CASE WHEN resolved THEN bar END, inside) AS aligned_bar, CASE WHEN resolved THEN delta END AS beat_delta, resolved, coalesce(sect, CASE WHEN n3.t >= sl.s THEN sl.section END) AS section FROM n3 JOIN sl USING (entity_id)""",
)
def aligned_notes(spark, sf_dir):
    rows, bars = beats_of(spark, sf_dir), bars_in_sections(spark, sf_dir)
    notes = rows.where("label = 'click'").select(E, "event_id", (F.col("t") + (F.col("k") - 30) * (10 * MINUTE)).alias("t"))
    sections = bars.groupBy(E, "section").agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"))
    return cards.aligned_notes(notes, rows.where("label <> 'click'"), bars, sections, 3 * HOUR).select("event_id", "aligned_idx", "aligned_bar", "beat_delta", "resolved", "section")


@query("section_titles", f"WITH {EN} SELECT event_id, CASE WHEN k % 5 = 0 THEN '' ELSE k || ' ' END || CASE WHEN k % 7 = 0 THEN 'Unlabeled' ELSE upper(label[1]) || label[2:] || ' Part' END || CASE WHEN k % 3 = 0 THEN '' ELSE printf(' (%.2f)', k / 100::DOUBLE) END AS title FROM en")
def section_titles(spark, sf_dir):
    k = F.col("k")
    label = F.when(k % 7 != 0, F.concat("label", F.lit("_part")))
    key = F.when(k % 5 != 0, F.concat(F.lit("section-"), k.cast("string")))
    return beats_of(spark, sf_dir).select("event_id", cards.section_title(label, key, F.when(k % 3 != 0, k / F.lit(100.0))).alias("title"))


@query("effect_complexity", f"WITH {EN} SELECT event_id, round(least(1::DOUBLE, (k % 4) * 0.12::DOUBLE + coalesce(CASE WHEN k % 6 <> 0 THEN k / 100::DOUBLE END, 0) * 0.45::DOUBLE + least(k % 8, 5) * 0.07::DOUBLE), 6) AS complexity FROM en")
def effect_complexity(spark, sf_dir):
    k = F.col("k")
    return beats_of(spark, sf_dir).select("event_id", cards.effect_complexity(k % 4, F.when(k % 6 != 0, k / F.lit(100.0)), k % 8).alias("complexity"))


_PITCH = "(36 + (energy + k) % 60)"
_SIG = ", ".join(f"count(*) FILTER ({_PITCH} % 12 = {i})::DOUBLE AS h{i}" for i in range(12))


@query(
    "window_signatures",
    f"""WITH {EN}, g AS (SELECT entity_id, (bar - 1) // 4 AS "window", {_SIG}, count(*) AS n, coalesce(sum(CASE WHEN label <> 'view' THEN {_PITCH} END)::BIGINT / nullif(count(CASE WHEN label <> 'view' THEN 1 END), 0)::DOUBLE, sum({_PITCH})::BIGINT / count(*)::DOUBLE) AS m, max({_PITCH}) - min({_PITCH}) AS span, count(*) FILTER (k * 20000 >= 500000) AS held FROM en GROUP BY 1, 2),
l AS (SELECT *, sqrt({' + '.join(f'h{i} * h{i}' for i in range(12))}) AS l FROM g) SELECT entity_id, "window", [{', '.join(f'h{i} / l' for i in range(12))}, n / 4::DOUBLE / 16::DOUBLE, m / 96::DOUBLE, span / 48::DOUBLE, held / n::DOUBLE] AS signature FROM l""",
)
def window_signatures(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    notes = rows.select(E, F.floor((F.col("bar") - 1) / 4).cast("long").alias("window"), (36 + (F.col("energy") + F.col("k")) % 60).alias("pitch"), (F.col("k") * 20_000).alias("length"), F.when(F.col("label") == "view", "bass").otherwise("keys").alias("stem"))
    return cards.window_signature(notes, ["window"], 4)


@query("fixture_roles", "WITH f AS (SELECT 'fix' || s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'x_head_el150' WHEN 1 THEN 'moving_head_2' ELSE 'par' END AS fixture FROM supplier UNION ALL SELECT unnest(['parcan_l', 'parcan_r', 'parcan_pl', 'parcan_pr']), 'par') SELECT CASE WHEN contains(fixture, 'head_el150') THEN 'moving_head_fx' WHEN contains(fixture, 'moving_head') THEN 'moving_head_main' WHEN id IN ('parcan_l', 'parcan_r') THEN 'parcan_inner' WHEN id IN ('parcan_pl', 'parcan_pr') THEN 'parcan_outer' ELSE 'support' END AS role, string_agg(id, ',' ORDER BY id) AS ids FROM f GROUP BY 1")
def fixture_roles(spark, sf_dir):
    kind = F.when(F.col("s_suppkey") % 4 == 0, "x_head_el150").when(F.col("s_suppkey") % 4 == 1, "moving_head_2").otherwise("par")
    made = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("fix"), F.col("s_suppkey").cast("string")).alias("id"), kind.alias("fixture"))
    named = spark.createDataFrame([(x, "par") for x in ("parcan_l", "parcan_r", "parcan_pl", "parcan_pr")], "id string, fixture string")
    return cards.fixture_roles(made.unionByName(named))


#: Cards of a song's sections: a mean to six digits, extremes, the motif that leads, hints by source, chord results.
@query(
    "song_cards",
    f"""WITH {EN}, s AS (SELECT entity_id, (idx - 1) // 8 AS section, round(sum(energy)::BIGINT / count(*)::DOUBLE, 6) AS mean_energy FROM en GROUP BY 1, 2),
m AS (SELECT entity_id, label, count(*) AS n, max(energy) AS refs FROM en GROUP BY 1, 2), x AS (SELECT entity_id, arg_max(label, {{'n': n, 'r': refs, 'l': label}}) AS dominant_motif FROM m WHERE n >= 2 GROUP BY 1),
h AS (SELECT entity_id, count(*) FILTER (k < 30) AS hints_user, count(*) FILTER (k >= 30) AS hints_inferred, count(*) FILTER (k % 4 = 0) AS missing, count(*) FILTER (k % 4 = 1) AS differs, count(*) FILTER (k % 4 > 1) AS matched, median(k) AS median_overlap FROM en GROUP BY 1)
SELECT s.entity_id, min(mean_energy) AS low, max(mean_energy) AS high, arg_max(section, {{'m': mean_energy, 's': -section}}) AS loudest, arg_min(section, {{'m': mean_energy, 's': section}}) AS quietest, max(dominant_motif) AS dominant_motif, max(hints_user) AS hints_user, max(hints_inferred) AS hints_inferred, max(missing) AS missing, max(differs) AS differs, max(matched) AS matched, max(median_overlap) AS median_overlap FROM s LEFT JOIN x USING (entity_id) JOIN h USING (entity_id) GROUP BY 1""",
)
def song_cards(spark, sf_dir):
    rows, k = beats_of(spark, sf_dir), F.col("k")
    sections = reports.mean_cards(rows, F.floor((F.col("idx") - 1) / 8).cast("long"), "energy", "section", "mean_energy")
    motifs = rows.groupBy(E, F.col("label").alias("motif")).agg(F.count("*").alias("occurrences"), F.max("energy").alias("refs"))
    counts = reports.conditions_counted(rows, {"hints_user": k < 30, "hints_inferred": k >= 30, "missing": k % 4 == 0, "differs": k % 4 == 1, "matched": k % 4 > 1}, {"median_overlap": "k"})
    return reports.extremes(sections, "mean_energy", "section").join(reports.dominant_motif(motifs), E, "left").join(counts, E)


@query(
    "anchors_in_window",
    f"""WITH {EN}, w AS (SELECT entity_id, (idx - 1) // 16 AS section, min(t) AS s, max(t) AS e FROM en GROUP BY 1, 2) SELECT w.entity_id, w.section, list(event_id ORDER BY t, event_id)[1:6] AS anchors FROM w JOIN en ON en.entity_id = w.entity_id AND en.t >= s AND en.t <= e WHERE label <> 'view' GROUP BY 1, 2""",
)
def anchors_in_window(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    spans = rows.groupBy(E, F.floor((F.col("idx") - 1) / 16).cast("long").alias("section")).agg(F.min("t").alias("start_t"), F.max("t").alias("end_t"))
    return reports.first_in_windows(rows.where("label <> 'view'"), spans, 5 * DAY, "section")


@query(
    "label_sets",
    f"""WITH {EN}, l AS (SELECT entity_id, bar, list(label ORDER BY idx) AS labels, list(event_id) AS ids FROM en GROUP BY 1, 2), n AS (SELECT *, lead(labels, 1, []) OVER (PARTITION BY entity_id ORDER BY bar) AS following FROM l)
SELECT entity_id, bar, list_filter(labels, lambda x, i: list_position(labels, x) = i) AS ordered, len(list_distinct(list_intersect(labels, following))) AS shared, len(list_filter(labels, lambda x: NOT list_contains(following, x))) = 0 AS subset, len(list_distinct(ids)) = len(ids) AS unique_ids FROM n""",
)
def label_sets(spark, sf_dir):
    lists = rows_of(spark, sf_dir).groupBy(E, "bar").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "label"))), lambda x: x["label"]).alias("_l"), (F.count_distinct("event_id") == F.count("*")).alias("unique_ids"))
    following = F.coalesce(F.lead("_l").over(Window.partitionBy(E).orderBy("bar")), F.array().cast("array<string>"))
    return reports.list_relations(lists.withColumn("_f", following), "_l", "_f").select(E, "bar", "ordered", "shared", "subset", "unique_ids")


#: What is exported of an event, by type; anything else gets the general hint. Stand-ins for a user's table.
HINTS = {"purchase": "Hit with full output.", "click": "Short accent.", "signup": "Slow fade in."}
GENERAL = "Use the event as a musical cue."


@query(
    "timeline_export",
    f"""WITH {EN} SELECT event_id, label AS type, t AS start_t, end_t, CASE WHEN k % 6 = 0 THEN 'human-edited' ELSE 'machine-only' END AS provenance, coalesce(CASE WHEN k % 5 <> 0 THEN 'rules' END, 'unknown') AS created_by, CASE label {' '.join(f"WHEN '{n}' THEN '{h}'" for n, h in HINTS.items())} ELSE '{GENERAL}' END AS lighting_hint, CASE WHEN k % 4 = 0 THEN 'festival' WHEN k % 4 = 1 THEN 'pop' ELSE 'default' END AS profile FROM en""",
)
def timeline_export(spark, sf_dir):
    k = F.col("k")
    genre = F.when(k % 4 == 0, "Festival").when(k % 4 == 1, "pop").when(k % 4 == 2, "Unheard Of")
    events = beats_of(spark, sf_dir).withColumns({"type": F.col("label"), "start_t": F.col("t"), "edited": k % 6 == 0, "created_by": F.when(k % 5 != 0, "rules")})
    profiles = events.select("event_id", reports.threshold_profile(genre, ["festival", "pop"]).alias("profile"))
    return reports.exported_events(events, HINTS, GENERAL).join(profiles, "event_id")


#: Targets of the validation report, and those that this run asks for.
TARGETS, ASKED = reports.TARGETS, ["beats", "chords", "energy", "events"]


@query(
    "validation_report",
    f"""WITH {EN}, c AS (SELECT entity_id, [{', '.join(f"'{x}'" for x in TARGETS)}][k % 8 + 1] AS target, energy >= 2000 AS ok FROM en), g AS (SELECT entity_id, target, count(*) FILTER (ok) AS matched, count(*) FILTER (NOT ok) AS mismatched FROM c GROUP BY 1, 2),
a AS (SELECT DISTINCT en.entity_id, t.target FROM en, (SELECT unnest([{', '.join(f"'{x}'" for x in TARGETS)}]) AS target) t)
SELECT a.entity_id, a.target, coalesce(matched, 0) AS matched, coalesce(mismatched, 0) AS mismatched, CASE WHEN a.target NOT IN ({', '.join(f"'{x}'" for x in ASKED)}) THEN 'skipped' WHEN coalesce(mismatched, 0) > 0 THEN 'failed' ELSE 'passed' END AS status,
  max(CASE WHEN a.target IN ({', '.join(f"'{x}'" for x in ASKED)}) AND coalesce(mismatched, 0) > 0 AND a.entity_id % 2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY a.entity_id) AS exit_code FROM a LEFT JOIN g USING (entity_id, target)""",
)
def validation_report(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    checks = rows.select(E, F.get(F.array(*[F.lit(x) for x in TARGETS]), (F.col("k") % 8).cast("int")).alias("target"), (F.col("energy") >= 2000).alias("ok"))
    return reports.target_report(rows.select(E).distinct(), checks, ASKED, F.col(E) % 2 == 0)


@query(
    "sliding_predictions",
    f"""WITH {EN}, w AS (SELECT x.entity_id, x.idx AS first_idx, max(y.t) AS last_t, x.t AS start_t, sum(y.k)::BIGINT / 800::DOUBLE AS p, count(*) AS n FROM en x JOIN en y ON x.entity_id = y.entity_id AND y.idx BETWEEN x.idx AND x.idx + 7 WHERE x.idx % 4 = 1 GROUP BY x.entity_id, x.idx, x.t)
SELECT entity_id, start_t, last_t AS end_t, p AS probability FROM w WHERE n = 8 AND p > 0.6::DOUBLE""",
)
def sliding_predictions(spark, sf_dir):
    """Windows of eight rows every four; the given probability of a window above the bound is an event."""
    return reports.window_events(beats_of(spark, sf_dir).withColumn("x", F.col("k")), F.col("s") / F.lit(800.0), 8, 4, 0.6)


@query("timing_override", f"WITH {EN}, r AS (SELECT entity_id, min(t) FILTER (k < 50) AS first, count(*) FILTER (k < 50) AS n FROM en GROUP BY 1), i AS (SELECT entity_id, min(t) AS first, count(*) AS n FROM en GROUP BY 1) SELECT i.entity_id, CASE WHEN coalesce(r.n, 0) >= 30 THEN 'reference' ELSE 'inferred' END AS source, CASE WHEN coalesce(r.n, 0) >= 30 THEN r.first ELSE i.first END AS first_t FROM i LEFT JOIN r USING (entity_id)")
def timing_override(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    return reports.timing_source(rows, rows.where("k < 50"), 30)
