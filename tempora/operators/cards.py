"""Grids, vectors and small cards of a song: reference grids, loudness frames, bar vectors, phrase windows, note
alignment, display forms and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PITCH_CLASSES
from . import joins
from .windows import ENTITY

#: Scale steps of the chords of a key, with what their names end in. Fixed values.
MAJOR = [(0, ""), (2, "m"), (4, "m"), (5, ""), (7, ""), (9, "m")]
MINOR = [(0, "m"), (2, "dim"), (3, ""), (5, "m"), (7, "m"), (8, ""), (10, "")]
#: Names of the first motif groups. Fixed values.
MOTIFS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]


def reference_grid(rows: DataFrame) -> DataFrame:
    """Beats of reference rows (t, bar, beat_in_bar; 0 or null for unknown): one row a time, in order, missing bar
    and beat numbers from the place, whether a new bar begins, and the tempo by the median gap."""
    w = Window.partitionBy(ENTITY).orderBy("t")
    firsts = rows.groupBy(ENTITY, "t").agg(F.min_by(F.struct("bar", "beat_in_bar"), "event_id").alias("_r"))
    placed = firsts.withColumn("idx", F.row_number().over(w))
    filled = placed.withColumns(
        {"bar": F.coalesce(F.nullif("_r.bar", F.lit(0)), F.floor((F.col("idx") - 1) / 4) + 1).cast("long"), "beat_in_bar": F.coalesce(F.nullif("_r.beat_in_bar", F.lit(0)), (F.col("idx") - 1) % 4 + 1).cast("long"), "_gap": F.greatest(F.lead("t").over(w) - F.col("t"), F.lit(1))}
    )
    tempo = filled.groupBy(ENTITY).agg((F.lit(60_000_000.0) / F.median("_gap")).alias("tempo"))
    starts = F.when(F.lag("bar").over(w).eqNullSafe(F.col("bar")), False).otherwise(True)
    return filled.withColumn("bar_start", starts).drop("_r", "_gap").join(tempo, ENTITY, "left")


def loudness_frames(samples: DataFrame, window: int, sources: list[str], x: str = "energy", by: str = "label") -> DataFrame:
    """Frames of ``window`` from each entity's first sample to its last: the root mean square of each source's
    samples, divided by the source's largest, as one array; zeros where a source is silent."""
    span = samples.groupBy(ENTITY).agg(F.min("t").alias("_a"), F.max("t").alias("_b"))
    frame = F.floor((F.col("t") - F.col("_a")) / window)
    power = samples.join(span, ENTITY).where(F.col(by).isin(sources)).groupBy(ENTITY, by, frame.alias("frame")).agg(F.sqrt(F.sum(F.col(x) * F.col(x)) / F.count("*")).alias("_rms"))
    top = F.max("_rms").over(Window.partitionBy(ENTITY, by))
    scaled = power.withColumn("_v", F.when(top > 1e-12, F.col("_rms") / top).otherwise(0.0))
    wide = scaled.groupBy(ENTITY, "frame").agg(*[F.max(F.when(F.col(by) == s, F.col("_v"))).alias(f"_{i}") for i, s in enumerate(sources)])
    count = F.greatest(F.lit(1), F.ceil((F.col("_b") - F.col("_a")) / window)).cast("long")
    grid = span.select(ENTITY, F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("frame"))
    return grid.join(wide, [ENTITY, "frame"], "left").select(ENTITY, "frame", F.array(*[F.coalesce(f"_{i}", F.lit(0.0)) for i in range(len(sources))]).alias("levels"))


def unit_mean(rows: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """The mean vector of each group, of unit length unless it is zero; and the root mean square of the first
    value, divided by the entity's largest."""
    means = rows.groupBy(ENTITY, *by).agg(*[(F.sum(v) / F.count("*")).alias(f"_m{i}") for i, v in enumerate(values)], F.sqrt(F.sum(F.col(values[0]) * F.col(values[0])) / F.count("*")).alias("_rms"))
    length = F.sqrt(sum((F.col(f"_m{i}") * F.col(f"_m{i}") for i in range(1, len(values))), F.col("_m0") * F.col("_m0")))
    top = F.max("_rms").over(Window.partitionBy(ENTITY))
    return means.select(ENTITY, *by, F.array(*[F.when(length > 0, F.col(f"_m{i}") / length).otherwise(0.0) for i in range(len(values))]).alias("vector"), F.when(top > 1e-12, F.col("_rms") / top).otherwise(0.0).alias("activity"))


def root_histogram(rows: DataFrame, by: list[str], values: list[str], root: str = "root", weight: str = "length") -> DataFrame:
    """Each group's vector: means of the values, then the share of its length that each of the twelve roots has."""
    total = F.sum(weight)
    bins = [F.when(total > 0, F.coalesce(F.sum(F.when(F.col(root) == i, F.col(weight))), F.lit(0)) / total).otherwise(0.0) for i in range(12)]
    return rows.groupBy(ENTITY, *by).agg(F.array(*[F.sum(v) / F.count("*") for v in values], *bins).alias("vector"))


def one_hot(x: Column, size: int = 12) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == x, 1.0).otherwise(0.0))


def timeline_index(tracks: dict[str, tuple[DataFrame, Column, Column, Column]]) -> DataFrame:
    """Tracks under common names: entity_id, kind, id, start_t, end_t. A track is (rows, id, start, end)."""
    out = None
    for kind, (rows, key, start, end) in tracks.items():
        part = rows.select(ENTITY, F.lit(kind).alias("kind"), key.cast("string").alias("id"), start.alias("start_t"), end.alias("end_t"))
        out = part if out is None else out.unionByName(part)
    return out


def phrase_windows(bars: DataFrame) -> DataFrame:
    """Bars (section, bar, start_t, end_t) of each section cut into windows: of four bars where the section has eight
    or more, of two where it has four or more, else one window."""
    whole = F.count("*").over(Window.partitionBy(ENTITY, "section"))
    place = F.row_number().over(Window.partitionBy(ENTITY, "section").orderBy("bar")) - 1
    size = F.when(F.col("_n") >= 8, 4).when(F.col("_n") >= 4, 2).otherwise(F.col("_n"))
    cut = bars.withColumns({"_n": whole, "_i": place}).withColumn("_w", F.floor(F.col("_i") / size))
    return cut.groupBy(ENTITY, "section", F.col("_w").cast("long").alias("window")).agg(F.min("bar").alias("start_bar"), F.max("bar").alias("end_bar"), F.min("start_t").alias("start_t"), F.max_by("end_t", "bar").alias("end_t"), F.count("*").alias("bar_count"))


def spectral_flux(frames: DataFrame, values: list[str]) -> DataFrame:
    """frames with ``flux``: the distance between the shares of consecutive frames' values; 0 for the first."""
    w = Window.partitionBy(ENTITY).orderBy("idx")
    total = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    shares = frames.withColumns({f"_s{i}": F.when(total > 0, F.col(v) / total).otherwise(0.0) for i, v in enumerate(values)})
    gaps = [F.col(f"_s{i}") - F.lag(f"_s{i}").over(w) for i in range(len(values))]
    squares = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
    return shares.withColumn("flux", F.coalesce(F.sqrt(squares), F.lit(0.0))).drop(*[f"_s{i}" for i in range(len(values))])


def edge_medians(deltas: DataFrame, x: str = "delta") -> DataFrame:
    """Medians of an entity's first and last deltas: half of them for six or fewer (two at least), else a quarter,
    three to sixteen."""
    n = F.count("*").over(Window.partitionBy(ENTITY))
    place = F.row_number().over(Window.partitionBy(ENTITY).orderBy("idx"))
    size = F.when(n <= 6, F.greatest(F.lit(2), F.floor(n / 2))).otherwise(F.greatest(F.lit(3), F.least(F.lit(16), F.floor(n / 4))))
    marked = deltas.withColumns({"_n": n, "_i": place, "_k": size})
    return marked.groupBy(ENTITY).agg(F.max("_k").cast("long").alias("window_size"), F.median(F.when(F.col("_i") <= F.col("_k"), F.col(x))).alias("start_median"), F.median(F.when(F.col("_i") > F.col("_n") - F.col("_k"), F.col(x))).alias("end_median"))


def shifted_boundaries(beats: DataFrame, boundaries: DataFrame, mix: list[str], bass: list[str], quiet: str) -> DataFrame:
    """boundaries (idx) moved by -1, 0 or +1 beats to the best score, the earliest of equals: half the mix's novelty,
    0.35 of the bass's, 0.15 of how quiet the vocals are. Novelty is one less the cosine of the two beats before and
    the two from here on. Beats at either end take no boundary."""
    w = Window.partitionBy(ENTITY).orderBy("idx")
    left, right = w.rowsBetween(-2, -1), w.rowsBetween(0, 1)

    def novelty(values: list[str]) -> Column:
        a, b = ([F.sum(v).over(frame).cast("double") for v in values] for frame in (left, right))
        dot = lambda x, y: sum((p * q for p, q in zip(x[1:], y[1:])), x[0] * y[0])
        size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
        return 1.0 - F.when(size > 0, dot(a, b) / size).otherwise(0.0)

    n = F.count("*").over(Window.partitionBy(ENTITY))
    scored = beats.withColumns({"_score": F.round(novelty(mix) * 0.5 + novelty(bass) * 0.35 + (1.0 - F.col(quiet)) * 0.15, 9), "_n": n}).where((F.col("idx") > 1) & (F.col("idx") < F.col("_n")))
    offered = boundaries.withColumn("_step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("_at", F.col("idx") + F.col("_step"))
    best = offered.join(scored.select(ENTITY, F.col("idx").alias("_at"), "_score"), [ENTITY, "_at"]).groupBy(ENTITY, "idx").agg(F.max_by("_at", F.struct("_score", -F.col("_at"))).alias("moved_idx"))
    return boundaries.join(best, [ENTITY, "idx"], "left").withColumn("moved_idx", F.coalesce("moved_idx", "idx"))


def majority_positions(rows: DataFrame, by: list[str], position: str, label: str, order: list[str]) -> DataFrame:
    """The label most members of a group have at each position; of equals the one that comes first in order."""
    counts = rows.groupBy(ENTITY, *by, position, label).agg(F.count("*").alias("_n"), F.min(F.struct(*order)).alias("_first"))
    rank = Window.partitionBy(ENTITY, *by, position).orderBy(F.desc("_n"), "_first")
    return counts.withColumn("_r", F.row_number().over(rank)).where("_r = 1").select(ENTITY, *by, position, label)


def display_bar(labels: Column) -> Column:
    """A bar's labels with dashes, neighbours that are equal once, N for none."""
    filled = F.transform(labels, lambda x: F.coalesce(x, F.lit("N")))
    return F.array_join(F.filter(filled, lambda x, i: (i == 0) | (x != F.get(filled, i - 1))), "-")


def display_runs(labels: Column) -> Column:
    """A list's runs, one after another: with an arrow beside a run of two or more, else a bar."""
    head = F.transform(labels, lambda x, i: (i == 0) | (x != F.get(labels, i - 1)))
    long_run = F.transform(labels, lambda x, i: (x == F.get(labels, i - 1)) | (x == F.get(labels, i + 1)))
    text = F.transform(labels, lambda x, i: F.when(~F.get(head, i), "").when(i == 0, x).otherwise(F.concat(F.when(F.coalesce(F.get(long_run, i - 1), F.lit(False)) | F.coalesce(F.get(long_run, i), F.lit(False)), "→").otherwise("|"), x)))
    return F.array_join(text, "")


def group_code(n: Column) -> Column:
    """A, B to Z, AA, AB and on, from 0, for whole numbers that are not negative."""
    codes, before = None, 0
    for letters in range(1, 14):  # as many letters as the largest long takes
        rest = n.cast("long") - before
        code = F.concat(*[F.char(F.floor(rest / 26**k).cast("long") % 26 + 65) for k in reversed(range(letters))])
        before += 26**letters
        codes = F.when(n < before, code) if codes is None else codes.when(n < before, code) if letters < 13 else codes.otherwise(code)
    return codes


def motif_name(n: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(m) for m in MOTIFS]), n.cast("int")), F.concat(F.lit("group_"), F.lpad((n + 1).cast("string"), 2, "0")))


def named_groups(windows_: DataFrame) -> DataFrame:
    """windows (grp, start_t) with the names of their groups: the larger first, then the one that starts first;
    ids count the windows of a group in order of time."""
    sizes = windows_.groupBy(ENTITY, "grp").agg(F.count("*").alias("n"), F.min("start_t").alias("_first"))
    rank = F.row_number().over(Window.partitionBy(ENTITY).orderBy(F.desc("n"), "_first")) - 1
    named = sizes.withColumn("_g", rank).withColumns({"phrase_group_id": F.concat(F.lit("phrase_group_"), group_code(F.col("_g"))), "motif_id": F.concat(F.lit("motif_"), motif_name(F.col("_g")))})
    place = F.row_number().over(Window.partitionBy(ENTITY, "grp").orderBy("start_t"))
    return windows_.join(named.drop("_first", "_g"), [ENTITY, "grp"]).withColumn("window_id", F.concat_ws("_", "phrase_group_id", place.cast("string")))


def diatonic_chord(root: Column, tonic: Column, major: Column) -> Column:
    """The chord of a key on a root (0 to 11), null where the key has none."""

    def named(steps: list[tuple[int, str]]) -> Column:
        names = F.array(*[F.lit(p) for p in PITCH_CLASSES])
        return F.coalesce(*[F.when(F.pmod(root - tonic, F.lit(12)) == step, F.concat(F.get(names, root.cast("int")), F.lit(ends))) for step, ends in steps])

    return F.when(major, named(MAJOR)).otherwise(named(MINOR))


def corrected_chords(chords: DataFrame, chroma: DataFrame, width: int, key: str, margin: float) -> DataFrame:
    """chords (chord, start_t, end_t, tonic, major) with ``corrected``: the key's chord on the bass's strongest pitch
    class over the chord's frames (t, c0 to c11), where it leads the second by the margin; else the chord itself."""
    met = joins.in_range(chroma, chords.select(ENTITY, key, "start_t", "end_t"), width)
    sums = met.groupBy(ENTITY, key).agg(F.array(*[F.struct((F.sum(f"c{i}") / F.count("*")).alias("v"), F.lit(i).alias("i")) for i in range(12)]).alias("_c"))
    ranked = sums.withColumn("_c", F.reverse(F.array_sort("_c")))
    top, second = F.col("_c")[0], F.col("_c")[1]
    candidate = diatonic_chord(top["i"], F.col("tonic"), F.col("major"))
    return chords.join(ranked, [ENTITY, key], "left").withColumn("corrected", F.when(F.col("_c").isNotNull() & (top["v"] - second["v"] >= margin), F.coalesce(candidate, "chord")).otherwise(F.col("chord"))).drop("_c")


def aligned_notes(notes: DataFrame, beats: DataFrame, bars: DataFrame, sections: DataFrame, tolerance: int) -> DataFrame:
    """notes (t) with the beat within the tolerance, else the bar they lie in; their distance to the beat, whether
    it was found, and their section (the last one beyond the end)."""
    near = joins.nearest(notes, beats.select(ENTITY, "t", "idx", "bar"), tolerance)
    inside = joins.containing(near, bars.select(ENTITY, F.col("bar").alias("_bar"), "start_t", "end_t")).withColumn("_inside", F.col("inside._bar")).drop("inside")
    placed = joins.containing(inside, sections, fallback_last=True)
    found = F.col("near").isNotNull()
    return placed.withColumns({"aligned_idx": F.col("near.idx"), "aligned_bar": F.coalesce("near.bar", "_inside"), "beat_delta": F.when(found, F.col("delta")), "resolved": found, "section": F.col("inside.section")}).drop("near", "delta", "inside", "_inside")


def section_title(label: Column, key: Column, confidence: Column) -> Column:
    """``12 Intro Part (0.50)``: the number in the id, the label in title case, the confidence."""
    name = F.coalesce(F.initcap(F.replace(label, F.lit("_"), F.lit(" "))), F.lit("Unlabeled"))
    number = F.regexp_extract(F.coalesce(key, F.lit("")), r"(\d+)", 1)
    return F.concat(F.when(number != "", F.concat(number, F.lit(" "))).otherwise(""), name, F.when(confidence.isNotNull(), F.concat(F.lit(" ("), F.format_string("%.2f", confidence), F.lit(")"))).otherwise(""))


def effect_complexity(phrases: Column, activity: Column, accents: Column) -> Column:
    """Phrases, motif activity and at most five accents, weighted, at most 1."""
    return F.round(F.least(F.lit(1.0), phrases * F.lit(0.12) + F.coalesce(activity, F.lit(0.0)) * F.lit(0.45) + F.least(accents, F.lit(5)) * F.lit(0.07)), 6)


def window_signature(notes: DataFrame, by: list[str], bars: int) -> DataFrame:
    """The vector of each window's notes (pitch, length, stem): unit histogram of pitch classes, density, mean pitch of
    what is not bass, span, and the share of notes held half a second or more (length in microseconds)."""
    counts = [F.count_if(F.pmod(F.col("pitch"), F.lit(12)) == i).cast("double").alias(f"_{i}") for i in range(12)]
    melodic = F.when(F.col("stem") != "bass", F.col("pitch"))
    n = F.count("*")
    cards = notes.groupBy(ENTITY, *by).agg(*counts, n.alias("_n"), (F.coalesce(F.sum(melodic) / F.count(melodic), F.sum("pitch") / n)).alias("_mean"), (F.max("pitch") - F.min("pitch")).alias("_span"), F.count_if(F.col("length") >= 500_000).alias("_held"))
    length = F.sqrt(sum((F.col(f"_{i}") * F.col(f"_{i}") for i in range(1, 12)), F.col("_0") * F.col("_0")))
    tail = [F.col("_n") / F.lit(float(bars)) / 16.0, F.col("_mean") / 96.0, F.col("_span") / 48.0, F.col("_held") / F.col("_n")]
    return cards.select(ENTITY, *by, F.array(*[F.col(f"_{i}") / length for i in range(12)], *tail).alias("signature"))


def fixture_roles(fixtures: DataFrame) -> DataFrame:
    """Fixture ids (id, fixture) by role, in order of role."""
    kind, key = F.col("fixture"), F.col("id")
    role = F.when(kind.contains("head_el150"), "moving_head_fx").when(kind.contains("moving_head"), "moving_head_main").when(key.isin("parcan_l", "parcan_r"), "parcan_inner").when(key.isin("parcan_pl", "parcan_pr"), "parcan_outer").otherwise("support")
    return fixtures.groupBy(role.alias("role")).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"))
