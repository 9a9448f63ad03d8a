"""Queries of sections, over bars of four rows and sections of five bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import song_sections, windows
from .registry import TL, query
from .timeline_queries import E, rows_of


def bars_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of(spark, sf_dir).withColumn("k", F.coalesce("k", F.lit(0)).cast("long"))
    e, k = F.col("e"), F.col("k")
    sums = rows.groupBy(E, F.col("bar").cast("long").alias("bar")).agg(F.min("t").alias("start_t"), F.max("t").alias("last_t"), F.sum("energy").alias("e"), F.sum("k").alias("k"))
    ended = sums.withColumn("end_t", F.coalesce(F.lead("start_t").over(windows.order("bar")), F.col("last_t")))
    features = {"energy": e * 3 + k, "onset": e * 7 + k * 5, "flux": e + k * 3, "vocals": e * 11 + k * 13, "drums": e * 5 + k * 7, "harmonic": e * 2 + k * 17, "bass": e + k * 29}
    return ended.select(E, "bar", "start_t", "end_t", F.floor((F.col("bar") - 1) / 5).cast("long").alias("section"), ((e * 13 + k * 11) % 1900).alias("contrast"), *[(x % 1000).alias(n) for n, x in features.items()])


def sections_from(bars: DataFrame) -> DataFrame:
    return bars.groupBy(E, "section").agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), *[F.floor(F.sum(f) / F.count("*")).cast("long").alias(f) for f in song_sections.FEATURES], (F.sum("contrast") % 1000).alias("repetition"))


BARS = f"""{TL}, b0 AS (SELECT entity_id, bar, min(t) AS start_t, max(t) AS last_t, sum(energy)::BIGINT AS e, sum(coalesce(k, 0))::BIGINT AS k FROM tl GROUP BY 1, 2),
bars AS (SELECT entity_id, bar, start_t, coalesce(lead(start_t) OVER (PARTITION BY entity_id ORDER BY bar), last_t) AS end_t, (bar - 1) // 5 AS section, (e * 13 + k * 11) % 1900 AS contrast,
  (e * 3 + k) % 1000 AS energy, (e * 7 + k * 5) % 1000 AS onset, (e + k * 3) % 1000 AS flux, (e * 11 + k * 13) % 1000 AS vocals, (e * 5 + k * 7) % 1000 AS drums, (e * 2 + k * 17) % 1000 AS harmonic, (e + k * 29) % 1000 AS bass FROM b0),
sec AS (SELECT entity_id, section, min(start_t) AS start_t, max(end_t) AS end_t, {', '.join(f'sum({f})::BIGINT // count(*) AS {f}' for f in song_sections.FEATURES)}, sum(contrast)::BIGINT % 1000 AS repetition FROM bars GROUP BY 1, 2)"""
BREAKS = f"""{BARS}, mk AS (SELECT *, energy <= 250 OR (drums >= 550 AND vocals <= 200 AND onset <= 500) AS strict, energy <= 300 OR (drums >= 550 AND vocals <= 200 AND onset <= 550) AS loose FROM bars),
rn AS (SELECT *, sum(CASE WHEN loose THEN 0 ELSE 1 END) OVER (PARTITION BY entity_id ORDER BY bar) AS run FROM mk),
fs AS (SELECT *, min(CASE WHEN strict THEN bar END) OVER (PARTITION BY entity_id, run) AS first FROM rn WHERE loose),
br AS (SELECT entity_id, min(start_t) AS start_t, arg_max(end_t, bar) AS end_t, min(bar) AS first_bar, count(*) AS bar_count, CASE WHEN count(*) <= 2 THEN 'pause_break' WHEN sum(drums) >= 550 * count(*) AND sum(energy) >= 250 * count(*) THEN 'percussion_break' ELSE 'breath_space' END AS break_type FROM fs WHERE bar >= first GROUP BY entity_id, run HAVING count(*) <= 4),
breaks AS (SELECT * FROM br WHERE NOT EXISTS (SELECT 1 FROM sec WHERE sec.entity_id = br.entity_id AND sec.start_t = br.start_t))"""


@query("micro_breaks", f"WITH {BREAKS} SELECT * FROM breaks")
def micro_breaks(spark, sf_dir):
    bars = bars_of(spark, sf_dir)
    return song_sections.micro_breaks(bars, sections_from(bars))


@query(
    "sections_with_breaks",
    f"""WITH {BREAKS}, i AS (SELECT s.entity_id, s.section, b.*, row_number() OVER (PARTITION BY s.entity_id, s.section ORDER BY b.start_t) AS rn FROM sec s JOIN breaks b ON s.entity_id = b.entity_id AND s.start_t < b.start_t AND b.end_t < s.end_t AND bar_count >= 3),
j AS (SELECT sec.entity_id, sec.start_t, sec.end_t, 'part' AS label, 0.3::DOUBLE + (sec.section % 7) / 10::DOUBLE AS confidence, i.start_t AS bs, i.end_t AS be, break_type FROM sec LEFT JOIN i ON i.entity_id = sec.entity_id AND i.section = sec.section AND rn = 1),
o AS (SELECT entity_id, start_t, coalesce(bs, end_t) AS end_t, label, confidence FROM j UNION ALL SELECT entity_id, bs, be, break_type, round(greatest(0.4::DOUBLE, confidence * 0.8::DOUBLE), 6) FROM j WHERE bs IS NOT NULL UNION ALL SELECT entity_id, be, end_t, label, confidence FROM j WHERE bs IS NOT NULL)
SELECT *, 'section-' || lpad(row_number() OVER (PARTITION BY entity_id ORDER BY start_t, end_t)::VARCHAR, 3, '0') AS section_id FROM o""",
)
def sections_with_breaks(spark, sf_dir):
    bars = bars_of(spark, sf_dir)
    sections = sections_from(bars)
    named = sections.select(E, "section", "start_t", "end_t", F.lit("part").alias("label"), (F.lit(0.3) + F.col("section") % 7 / F.lit(10.0)).alias("confidence"))
    return song_sections.split_at_breaks(named, song_sections.micro_breaks(bars, sections))


def split_bars(bars: DataFrame) -> DataFrame:
    """Sections of ten bars whose features rise half-way, in half of them, so that some are split."""
    wide = bars.withColumn("section", F.floor((F.col("bar") - 1) / 10).cast("long"))
    lifted = (F.col("bar") - 1) % 10 >= 5
    up = lambda x, by: F.when(lifted, F.col(x) % 400 + by).otherwise(F.col(x) % 400)
    return wide.withColumns({"energy": up("energy", 450), "onset": up("onset", 450), "drums": up("drums", 450), "contrast": F.when((F.col("bar") - 1) % 10 == 5, F.col("contrast") + 600).otherwise(F.col("contrast") % 1000)})


SPLITS = f"""{BARS}, w0 AS (SELECT entity_id, bar, start_t, end_t, (bar - 1) // 10 AS section, CASE WHEN (bar - 1) % 10 = 5 THEN contrast + 600 ELSE contrast % 1000 END AS contrast, {', '.join(f'{f} % 400 + CASE WHEN (bar - 1) % 10 >= 5 THEN 450 ELSE 0 END AS {f}' for f in ('energy', 'onset', 'drums'))} FROM bars),
w1 AS (SELECT *, row_number() OVER s - 1 AS i, count(*) OVER (PARTITION BY entity_id, section) AS n, {', '.join(f'sum({f}) OVER (PARTITION BY entity_id, section ORDER BY bar ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS l_{f}, sum({f}) OVER (PARTITION BY entity_id, section ORDER BY bar ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS r_{f}, min({f}) OVER (PARTITION BY entity_id, section ORDER BY bar ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS low_{f}' for f in ('energy', 'onset', 'drums'))} FROM w0 WINDOW s AS (PARTITION BY entity_id, section ORDER BY bar)),
w2 AS (SELECT *, i >= 2 AND i <= n - 2 AS offered FROM w1), w3 AS (SELECT *, sum(CASE WHEN offered THEN contrast END) OVER (PARTITION BY entity_id, section) AS s, count(CASE WHEN offered THEN contrast END) OVER (PARTITION BY entity_id, section) AS c FROM w2),
sp AS (SELECT entity_id, section, arg_max(bar, {{'c': contrast, 't': start_t}}) AS split_bar FROM w3 WHERE offered AND contrast >= 900 AND contrast * c >= s + 280 * c AND r_energy - l_energy >= 240 AND r_onset - l_onset >= 240 AND r_drums - l_drums >= 360 AND low_energy * 2 >= l_energy + 160 AND low_onset * 2 >= l_onset + 160 GROUP BY 1, 2)"""


@query(
    "internal_splits",
    f"""WITH {SPLITS} SELECT entity_id, section, min(bar) AS bar_start, max(bar) AS bar_end, min(start_t) AS start_t, arg_max(end_t, bar) AS end_t, count(*) AS bar_count, sum(energy)::BIGINT AS energy_sum, sum(onset)::BIGINT AS onset_sum, sum(drums)::BIGINT AS drums_sum, part = 1 AS preserve_start
FROM (SELECT w0.*, CASE WHEN bar >= split_bar THEN 1 ELSE 0 END AS part FROM w0 LEFT JOIN sp USING (entity_id, section)) GROUP BY entity_id, section, part""",
)
def internal_splits(spark, sf_dir):
    bars = split_bars(bars_of(spark, sf_dir))
    return song_sections.apply_splits(bars, song_sections.internal_splits(bars))


def _quantile(x: str, m: int) -> str:
    return f"(SELECT sum(CASE WHEN rn = (n - 1) * {m} // 20 THEN {x} * (20 - (n - 1) * {m} % 20) WHEN rn = (n - 1) * {m} // 20 + 1 THEN {x} * ((n - 1) * {m} % 20) ELSE 0 END) FROM (SELECT {x}, row_number() OVER (ORDER BY {x}) - 1 AS rn, count(*) OVER () AS n FROM s0 y WHERE y.entity_id = e.entity_id))"


@query(
    "section_characters",
    f"""WITH {BARS}, s0 AS (SELECT *, onset + flux AS motion FROM sec), e AS (SELECT DISTINCT entity_id FROM s0),
q AS (SELECT entity_id, {_quantile('energy', 7)} AS el, {_quantile('energy', 14)} AS eh, {_quantile('energy', 17)} AS ep, {_quantile('motion', 7)} AS ml, {_quantile('motion', 14)} AS mh, {_quantile('repetition', 10)} AS rm FROM e),
x AS (SELECT s0.*, q.* EXCLUDE (entity_id), row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY entity_id) AS n, energy - coalesce(lag(energy) OVER w, energy) AS delta, coalesce(lead(energy) OVER w, energy) AS ne, coalesce(lead(motion) OVER w, motion) AS nm, coalesce(lead(drums) OVER w, drums) AS nd FROM s0 JOIN q USING (entity_id) WINDOW w AS (PARTITION BY entity_id ORDER BY section))
SELECT entity_id, section, CASE WHEN i = 0 AND vocals >= 450 AND drums <= 200 THEN 'vocal_spotlight' WHEN i = 0 THEN 'ambient_opening' WHEN i = n - 1 THEN 'release_tail'
WHEN repetition * 20 < rm AND ne - energy >= 120 AND nm * 20 >= mh AND nd >= 450 THEN 'contrast_bridge'
WHEN vocals * 10 >= greatest((drums + 200) * 10, harmonic * 8) AND drums * 40 <= ml + 2000 THEN CASE WHEN energy * 20 >= eh THEN 'vocal_lift' ELSE 'vocal_spotlight' END
WHEN harmonic + bass >= 700 AND vocals <= 250 AND drums <= 450 THEN 'instrumental_bed' WHEN harmonic >= 450 AND drums <= 300 AND delta >= 40 AND vocals <= 250 THEN 'arpeggiated_lift'
WHEN delta >= 80 AND motion * 20 >= mh AND drums >= 450 AND (vocals >= 100 OR bass >= 350 OR harmonic >= 120) THEN 'momentum_lift' WHEN drums >= 550 AND harmonic <= 350 AND vocals <= 250 THEN 'percussion_break'
WHEN energy * 20 >= ep AND (repetition * 20 >= rm OR motion * 20 >= mh) THEN 'focal_lift' WHEN delta >= 40 AND motion * 20 >= mh THEN 'momentum_lift' WHEN energy * 20 <= el AND motion * 20 <= ml + 400 THEN 'breath_space'
WHEN i = 1 AND energy * 20 <= el + 200 AND motion * 20 <= mh - 800 THEN 'breath_space' WHEN repetition * 20 < rm AND (motion * 20 >= mh OR abs(delta) >= 50) THEN 'contrast_bridge' WHEN motion * 20 >= mh OR energy * 20 >= eh THEN 'groove_plateau' ELSE 'flowing_plateau' END AS character FROM x""",
)
def section_characters(spark, sf_dir):
    return song_sections.characters(sections_from(bars_of(spark, sf_dir))).select(E, "section", "character")


@query(
    "phrase_blocks",
    f"""WITH RECURSIVE {BARS}, c AS (SELECT entity_id, (bar - 1) // 2 AS block, count(*) AS bar_count, sum(energy)::BIGINT % 120 + 400 AS energy, max(contrast) AS contrast, sum(vocals)::BIGINT AS a, sum(drums)::BIGINT AS b FROM bars GROUP BY 1, 2),
v AS (SELECT *, CASE WHEN a * a + b * b > 0 THEN a / sqrt((a * a + b * b)::DOUBLE) ELSE 0 END AS x, CASE WHEN a * a + b * b > 0 THEN b / sqrt((a * a + b * b)::DOUBLE) ELSE 0 END AS y FROM c),
w AS (SELECT *, x * lead(x) OVER o + y * lead(y) OVER o >= {song_sections.SIMILARITY}::DOUBLE AS alike FROM v WINDOW o AS (PARTITION BY entity_id ORDER BY block)),
l AS (SELECT entity_id, count(*) AS n, list(energy ORDER BY block) AS e, list(coalesce(alike, false) ORDER BY block) AS al, list(block ORDER BY block) AS bl, coalesce((list(contrast ORDER BY block))[2] >= {song_sections.INTRO_CONTRAST}, false) AS stands FROM w GROUP BY 1),
s AS (SELECT *, n >= 2 AND stands AS keep, n > 2 AND al[1] AND NOT stands AND (e[1] + e[2]) / 2 < list_median(e[3:]) AS opens FROM l),
g AS (SELECT entity_id, n, e, al, bl, keep, 1::BIGINT AS i, CASE WHEN opens THEN 2 ELSE 0 END::BIGINT AS size, 0::BIGINT AS grp, NULL::BIGINT AS before_ FROM s UNION ALL
  SELECT entity_id, n, e, al, bl, keep, i + size, CASE WHEN i + size < n AND NOT (i + size = 1 AND keep) AND NOT coalesce(e[i + size] - b > {song_sections.ENTRY_JUMP}, false) AND al[i + size] AND abs(e[i + size] - e[i + size + 1]) <= {song_sections.ENERGY_DELTA} THEN 2 ELSE 1 END, grp + CASE WHEN size > 0 THEN 1 ELSE 0 END, b
  FROM (SELECT *, CASE WHEN size > 0 THEN e[i + size - 1] END AS b FROM g) WHERE i + size <= n),
m AS (SELECT g.entity_id, grp, w.* EXCLUDE (entity_id) FROM g JOIN w ON w.entity_id = g.entity_id AND w.block BETWEEN bl[i] AND bl[i + size - 1] WHERE size > 0),
r AS (SELECT entity_id, grp::INTEGER AS grp, min(block) AS first_block, max(block) AS last_block, sum(bar_count)::BIGINT AS bar_count, sum(energy)::BIGINT / count(*) AS energy, sum(x) / count(*) AS x, sum(y) / count(*) AS y FROM m GROUP BY 1, 2)
SELECT entity_id, grp::BIGINT AS grp, first_block, last_block, bar_count, energy, CASE WHEN sqrt(x * x + y * y) > 0 THEN [x / sqrt(x * x + y * y), y / sqrt(x * x + y * y)] ELSE [x, y] END AS vector FROM r""",
)
def phrase_blocks(spark, sf_dir):
    """Blocks of two bars, grouped and merged."""
    bars = bars_of(spark, sf_dir)
    block = F.floor((F.col("bar") - 1) / 2).cast("long")
    cards = bars.groupBy(E, block.alias("block")).agg(F.count("*").alias("bar_count"), (F.sum("energy") % 120 + 400).alias("energy"), F.max("contrast").alias("contrast"), F.sum("vocals").alias("_a"), F.sum("drums").alias("_b"))
    length = F.sqrt((F.col("_a") * F.col("_a") + F.col("_b") * F.col("_b")).cast("double"))
    blocks = cards.withColumn("vector", F.array(*[F.when(length > 0, F.col(x) / length).otherwise(0.0) for x in ("_a", "_b")])).drop("_a", "_b")
    return song_sections.merge_groups(blocks, song_sections.group_blocks(blocks), 2)
