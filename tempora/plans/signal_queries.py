"""Queries of spectra, MIDI files and feature blocks, over signals and notes made from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spectrum, tensor
from ..sources import midi
from .feature_queries import beats_of
from .registry import TL, query
from .timeline_queries import E, rows_of

FRAME, HOP, BLOCK = 32, 8, 40
TEMPOS = [(1920, 400_000), (9600, 600_000)]


@query(
    "frame_spectrum",
    f"""WITH {TL}, x AS (SELECT entity_id, idx - 1 AS i, energy::DOUBLE AS v FROM tl), len AS (SELECT entity_id, count(*) AS n FROM x GROUP BY 1),
fr AS (SELECT entity_id, f FROM len, unnest(range(0, 1 + (greatest(0, n - {FRAME}) + {HOP - 1}) // {HOP})) AS r(f)),
fx AS (SELECT fr.entity_id, f, i - f * {HOP} AS n, v FROM fr JOIN x ON x.entity_id = fr.entity_id AND i >= f * {HOP} AND i < f * {HOP} + {FRAME}),
bins AS (SELECT entity_id, f, k, sqrt(pow(sum(v * (0.5::DOUBLE - 0.5::DOUBLE * cos(2 * pi() * n / {FRAME - 1})) * cos(2 * pi() * ((k * n) % {FRAME}) / {FRAME})), 2) + pow(sum(v * (0.5::DOUBLE - 0.5::DOUBLE * cos(2 * pi() * n / {FRAME - 1})) * sin(2 * pi() * ((k * n) % {FRAME}) / {FRAME})), 2)) AS m FROM fx, range({FRAME // 2 + 1}) AS b(k) GROUP BY ALL),
t AS (SELECT entity_id, f, k, m, m / greatest(sum(m) OVER (PARTITION BY entity_id, f), 1e-8::DOUBLE) AS p FROM bins),
fl AS (SELECT a.entity_id, a.f, sum(a.m * a.k / {float(FRAME)}::DOUBLE) / sum(a.m) AS centroid, CASE WHEN a.f = 0 THEN 0 ELSE sqrt(sum(pow(a.p - b.p, 2))) END AS flux FROM t a LEFT JOIN t b ON a.entity_id = b.entity_id AND a.f = b.f + 1 AND a.k = b.k GROUP BY 1, 2),
rms AS (SELECT entity_id, f, sqrt(sum(v * v) / {FRAME}) AS loudness FROM fx GROUP BY 1, 2)
SELECT entity_id, f AS frame_index, f * {float(HOP)}::DOUBLE AS time, round(loudness, 6) AS loudness, round(centroid, 6) AS spectral_centroid, round(flux, 6) AS spectral_flux, round(greatest(flux, loudness), 6) AS onset_strength FROM fl JOIN rms USING (entity_id, f)""",
)
def frame_spectrum(spark, sf_dir):
    rows = rows_of(spark, sf_dir)
    block = F.floor((F.col("idx") - 1) / BLOCK).cast("long")
    samples = F.transform(F.array_sort(F.collect_list(F.struct("idx", "energy"))), lambda r: r["energy"].cast("double"))
    blocks = rows.groupBy(E, (block * BLOCK).alias("start")).agg(samples.alias("samples"))
    found = spectrum.frame_measures(blocks, FRAME, HOP, 1.0)
    return found.select(E, "frame_index", "time", *[F.round(m, 6).alias(m) for m in spectrum.MEASURES])


def _seconds(tick: str) -> str:
    return f"round(CASE WHEN {tick} < 1920 THEN {tick} / 960::DOUBLE WHEN {tick} < 9600 THEN 2 + ({tick} - 1920) / 1200::DOUBLE ELSE 8.4::DOUBLE + ({tick} - 9600) / 800::DOUBLE END, 6)"


@query(
    "midi_notes",
    f"""WITH {TL}, n AS (SELECT entity_id, (idx - 1) * 240 + coalesce(k, 0) % 100 AS s, 60 + energy % 61 AS d, idx % 3 AS channel, 36 + coalesce(k, 0) % 48 AS pitch, 1 + energy % 127 AS velocity FROM tl)
SELECT entity_id, 0 AS track, channel, 0 AS program, pitch, velocity, {_seconds('s')} AS start_s, {_seconds('(s + d)')} AS end_s, NULL::VARCHAR AS error FROM n""",
)
def midi_notes(spark, sf_dir):
    rows, start = beats_of(spark, sf_dir), (F.col("idx") - 1) * 240 + F.col("k") % 100
    notes = rows.select(E, start.alias("start_tick"), (start + 60 + F.col("energy") % 61).alias("end_tick"), (F.col("idx") % 3).alias("channel"), (F.col("k") % 48 + 36).alias("pitch"), (F.col("energy") % 127 + 1).alias("velocity"))
    return midi.midi_notes(midi.as_midi(notes, 480, TEMPOS))


FEATURES = [f"{label}{n}" for label in ("click", "error", "purchase", "signup", "view") for n in range(3)]


@query(
    "feature_blocks",
    f"""WITH {TL}, f AS (SELECT entity_id, idx, t, label || (coalesce(k, 0) % 3)::VARCHAR AS key, energy FROM tl),
p AS (PIVOT f ON key IN ({', '.join(f"'{k}'" for k in FEATURES)}) USING coalesce(sum(energy), 0) GROUP BY entity_id, idx, t),
u AS (UNPIVOT p ON {', '.join(f'"{k}"' for k in FEATURES)} INTO NAME feature VALUE value)
SELECT entity_id, (idx - 1) // 16 AS block, idx, t, feature, value::BIGINT AS value FROM u WHERE feature IN (SELECT key FROM f)""",
)
def feature_blocks(spark, sf_dir):
    rows = beats_of(spark, sf_dir)
    made = rows.select(E, "idx", "t", F.create_map(F.concat("label", (F.col("k") % 3).cast("string")), F.col("energy").cast("double")).alias("normalized"))
    keys = tensor.feature_keys(made, ["normalized"])
    blocks = tensor.feature_blocks(made, keys, 16)
    names = F.array(*[F.lit(k) for _, k in keys])
    cells = blocks.select(E, "block", F.posexplode(F.arrays_zip("idx", "times")).alias("r", "at"), "values").select(E, "block", "r", "at.*", F.posexplode("values").alias("f", "line"))
    return cells.select(E, "block", "idx", F.col("times").alias("t"), F.get(names, F.col("f")).alias("feature"), F.get("line", F.col("r")).cast("long").alias("value"))
