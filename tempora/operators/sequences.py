"""Order-dependent operators: runs, islands, cooldowns and repeated sequences.

Runs and islands are window sums. Greedy choices stream over an entity's sorted rows where one number is
carried, and are grouped pandas functions where more is; an entity is one song's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PITCH_CLASSES
from .cards import MAJOR, MINOR
from .windows import ENTITY, changed, decided_chunks, each_group, order


#: Weights of a repeated sequence: bars covered, its length, its count, a length of four, a differing beat. Fixed
#: values.
PATTERN_SCORE = {"bars": 1000, "length": 10, "found": 1, "four": 50, "error": 5}


def runs(rows: DataFrame, label: str = "label", values: list[str] | None = None) -> DataFrame:
    """Runs of equal labels: run, label, first and last idx, start, end (start of the next run, or
    the entity's last time), rows and sums of values."""
    marked = rows.withColumn("run", F.sum(changed(label)).over(order().rowsBetween(Window.unboundedPreceding, 0)))
    flat = marked.withColumn("run", F.col("run").cast("int")).withColumn("_last", F.max("t").over(Window.partitionBy(ENTITY)))
    out = flat.groupBy(ENTITY, "run").agg(
        F.min(label).alias(label), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.min("t").alias("start_t"), F.max("_last").alias("_last"), F.count("*").alias("n_rows"), *[F.sum(v).alias(f"{v}_sum") for v in values or []]
    )
    return out.withColumn("end_t", F.coalesce(F.lead("start_t").over(Window.partitionBy(ENTITY).orderBy("run")), "_last")).drop("_last")


def merge_equal(events: DataFrame, label: str = "label", confidence: str = "confidence") -> DataFrame:
    """Adjacent events of one label joined; the confidence is averaged pairwise from the left."""
    w = Window.partitionBy(ENTITY).orderBy("start_t")
    island = events.withColumn("_i", F.sum(F.when(F.lag(label).over(w).eqNullSafe(F.col(label)), 0).otherwise(1)).over(w))
    ordered = F.array_sort(F.collect_list(F.struct("start_t", confidence)))
    grouped = island.groupBy(ENTITY, "_i").agg(F.min(label).alias(label), F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), ordered.alias("_c"))
    fold = F.aggregate(F.slice("_c", 2, F.greatest(F.size("_c") - 1, F.lit(0))), F.element_at("_c", 1)[confidence], lambda s, x: (s + x[confidence]) / 2)
    return grouped.withColumn(confidence, fold).drop("_i", "_c")


def islands(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Groups of rows with consecutive idx (and equal ``by``): first and last idx, times, rows."""
    by = by or []
    w = Window.partitionBy(ENTITY, *by).orderBy("idx")
    keyed = rows.withColumn("_k", F.col("idx") - F.row_number().over(w))
    return keyed.groupBy(ENTITY, *by, "_k").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.min("t").alias("start_t"), F.max("t").alias("last_t"), F.count("*").alias("n_rows")).drop("_k")


def kept_rows(t: np.ndarray, first: np.ndarray, gap: int, strict: bool, last: int | None) -> tuple[np.ndarray, int]:
    """Places of the rows that a greedy cooldown keeps of times in order, ``first`` marking the first row of each entity; ``last`` is the time
    last kept of the entity that the first row goes on with. Rows far enough behind the row before are kept at once; only
    between those the choice jumps from one kept row to the next."""
    side = "right" if strict else "left"
    step = np.diff(t, prepend=t[:1])
    fresh = first | ((step > gap) if strict else (step >= gap))
    fresh[0] = first[0] or last is None
    keep = fresh.copy()
    heads = np.flatnonzero(fresh)
    runs = [] if fresh[0] else [(0, int(heads[0]) if len(heads) else len(t), last)]
    ends = np.append(heads[1:], len(t))
    long = ends - heads > 1
    runs += [(int(a) + 1, int(b), int(t[a])) for a, b in zip(heads[long], ends[long])]
    for at, end, before in runs:
        while True:
            at += int(np.searchsorted(t[at:end], before + gap, side))
            if at >= end:
                break
            keep[at], before = True, int(t[at])
            at += 1
    places = np.flatnonzero(keep)
    since = np.flatnonzero(first)
    recent = places[places >= since[-1]] if len(since) else places
    return places, int(t[recent[-1]]) if len(recent) else last


def cooldown(rows: DataFrame, gap: int, strict: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Rows kept greedily in time order: the first, then each at least ``gap`` (more than, if
    strict) after the last kept. One shuffle by entity; a task streams its sorted rows and remembers one time."""
    out = [ENTITY, "t", "event_id", *(keep or [])]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = rows.select(out).repartition(n, ENTITY).sortWithinPartitions(ENTITY, "t", "event_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0)
            follows = pc.equal(own.slice(1), own.slice(0, len(own) - 1))
            both_null = pc.and_(pc.is_null(own.slice(1)), pc.is_null(own.slice(0, len(own) - 1)))
            start = before is None or before[0] != own[0].as_py()
            first = np.concatenate([[start], ~pc.or_(pc.fill_null(follows, False), both_null).to_numpy(zero_copy_only=False)])
            places, last = kept_rows(batch.column(1).to_numpy(zero_copy_only=False), first, gap, strict, last)
            before = (own[len(own) - 1].as_py(),)
            yield batch.take(pa.array(places))

    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    return dealt.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in out))


def ngrams(rows: DataFrame, size: int, least: int, label: str = "label") -> DataFrame:
    """Sequences of ``size`` labels, overlapping ones included, that occur ``least`` times."""
    parts = [F.lead(label, k).over(order()) for k in range(size)]
    whole = F.concat_ws(">", *parts)
    return rows.withColumn("pattern", F.when(parts[-1].isNotNull(), whole)).where("pattern is not null").groupBy(ENTITY, "pattern").agg(F.count("*").alias("n"), F.min("idx").alias("first_idx")).where(F.col("n") >= least)


def mismatches(a: Column, b: Column) -> Column:
    """Places at which two equally long arrays differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1)), F.lit(0), lambda s, v: s + v)


def repeating_unit(labels: Column) -> Column:
    """Length of the shortest prefix whose repeats make up the array."""
    n = F.size(labels)
    fits = F.filter(F.sequence(F.lit(1), n), lambda k: (n % k == 0) & (F.flatten(F.array_repeat(F.slice(labels, 1, k), (n / k).cast("int"))) == labels))
    return F.element_at(fits, 1)


def bar_labels(rows: DataFrame, label: str = "label") -> DataFrame:
    """Complete bars: entity_id, bar, and the labels of beats 1 to 4 in order."""
    grouped = rows.groupBy(ENTITY, "bar").agg(F.array_sort(F.collect_list(F.struct("beat_in_bar", F.col(label).alias("l")))).alias("_b"), F.count_distinct("beat_in_bar").alias("_n"))
    return grouped.where((F.col("_n") == 4) & (F.size("_b") == 4)).select(ENTITY, "bar", F.transform("_b", lambda x: x["l"]).alias("beats"))


class PatternMiner:
    """Repeated sequences of one entity's bars (a matrix of beat codes). Windows that may match share a piece: of one more pieces than beats may
    differ, one agrees throughout. Matches are looked up so once for each length; what a start finds is kept, and found again only
    where bars that it used are gone."""

    def __init__(self, grid: np.ndarray, longest: int, tolerated: int):
        self.grid, n = grid, len(grid)
        self.lengths = [x for x in dict.fromkeys([4, *range(min(longest, n // 2), 1, -1)]) if x <= n]
        self.matches = {length: self.matching(length, 0 if length == 2 else tolerated) for length in self.lengths}
        self.found = {(rank, first): self.occurrences(length, first, np.ones(n - length + 1, dtype=bool)) for rank, length in enumerate(self.lengths) for first in range(n - length + 1)}

    def matching(self, length: int, allowed: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each start the later starts whose windows differ in at most ``allowed`` beats, and in how many."""
        flat, width = self.grid.ravel(), self.grid.shape[1]
        starts, edges = len(self.grid) - length + 1, [width * length * j // (allowed + 1) for j in range(allowed + 2)]
        shared: dict[tuple[int, bytes], list[int]] = {}
        keys = [[(j, flat[width * s + a : width * s + b].tobytes()) for j, (a, b) in enumerate(zip(edges, edges[1:]))] for s in range(starts)]
        for s, own in enumerate(keys):
            for key in own:
                shared.setdefault(key, []).append(s)
        places = {key: np.array(at) for key, at in shared.items()}
        windows_ = np.lib.stride_tricks.sliding_window_view(flat, width * length)[::width]
        out = []
        for s, own in enumerate(keys):
            later = np.unique(np.concatenate([at[np.searchsorted(at, s, "right") :] for at in (places[k] for k in own)]))
            wrong = (windows_[later] != windows_[s]).sum(axis=1)
            out.append((later[wrong <= allowed], wrong[wrong <= allowed]))
        return out

    def occurrences(self, length: int, first: int, free: np.ndarray) -> tuple[list[int], list[int]] | None:
        """Places and differences of windows like that at ``first`` that do not overlap, taken from the left among free ones; None for fewer than two."""
        later, wrong = self.matches[length][first]
        open_ = free[later]
        later, wrong = later[open_], wrong[open_]
        at, errors, k = [first], [0], int(np.searchsorted(later, first + length))
        while k < len(later):
            at.append(int(later[k]))
            errors.append(int(wrong[k]))
            k = int(np.searchsorted(later, later[k] + length))
        return (at, errors) if len(at) > 1 else None

    def score(self, length: int, at: list[int], errors: list[int]) -> int:
        w = PATTERN_SCORE
        return w["bars"] * len(at) * length + w["length"] * length + w["found"] * len(at) + w["four"] * (length == 4) - w["error"] * sum(errors)

    def patterns(self) -> Iterator[tuple[int, list[int], list[int]]]:
        """(length, places, differences) of the best sequence, then of the best among bars that are left, until none repeats."""
        used = np.zeros(len(self.grid), dtype=bool)
        live = {key: (self.score(self.lengths[key[0]], *found), found) for key, found in self.found.items() if found}
        while live:
            (rank, _), (_, (at, errors)) = max(live.items(), key=lambda e: (e[1][0], -e[0][0], -e[0][1]))
            length = self.lengths[rank]
            yield length, at, errors
            for s in at:
                used[s : s + length] = True
            gone = np.concatenate([[0], np.cumsum(used)])
            free = [gone[x:] == gone[: len(gone) - x] for x in self.lengths]
            for key, (_, (places, _)) in list(live.items()):
                rank, first = key
                if free[rank][places].all():
                    continue
                found = self.occurrences(self.lengths[rank], first, free[rank]) if free[rank][first] else None
                if found:
                    live[key] = (self.score(self.lengths[rank], *found), found)
                else:
                    del live[key]


def mine_patterns(bars: DataFrame, longest: int = 24, tolerated: int = 3) -> DataFrame:
    """Repeated bar sequences: for each length (4 first, then longest down to 2) non-overlapping occurrences from the left
    with at most ``tolerated`` differing beats (none for 2 bars), over the list of complete bars, so that a bar
    left out does not break a sequence; the best by covered bars, length,
    count and differences is taken, its bars are used up, until none repeats.
    Rows: entity_id, pattern, start_bar, end_bar, mismatches."""

    def mine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bar")
        numbers, codes, out = pdf["bar"].to_numpy(), {}, []
        grid = np.array([[codes.setdefault(x, len(codes)) for x in b] for b in pdf["beats"]], dtype=np.int32).reshape(-1, 4)
        for pattern, (length, at, errors) in enumerate(PatternMiner(grid, longest, tolerated).patterns(), start=1):
            out += [(pdf[ENTITY].iloc[0], pattern, int(numbers[s]), int(numbers[s + length - 1]), wrong) for s, wrong in zip(at, errors)]
        return pd.DataFrame(out, columns=[ENTITY, "pattern", "start_bar", "end_bar", "mismatches"])

    return bars.groupBy(ENTITY).applyInPandas(mine, f"{ENTITY} long, pattern int, start_bar int, end_bar int, mismatches int")


def absorb_short_runs(rows: DataFrame, least: int = 3, label: str = "label", strength: str = "energy") -> DataFrame:
    """Labels with runs shorter than ``least`` merged into a neighbour: into both if those agree, else
    into the one of higher mean strength, the previous on a tie; anew after each change until none
    is left. Rows that change take over the strength that decided. Rows: entity_id, idx, label."""

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        runs_: list[list] = []  # label, rows, sum of strengths, first strength
        for name, power in zip(pdf[label], pdf[strength].astype(float)):
            if runs_ and runs_[-1][0] == name:
                runs_[-1][1] += 1
                runs_[-1][2] += power
            else:
                runs_.append([name, 1, power, power])
        k = 0
        while k < len(runs_) and len(runs_) > 1:
            if runs_[k][1] >= least:
                k += 1
                continue
            before = runs_[k - 1] if k else None
            after = runs_[k + 1] if k + 1 < len(runs_) else None
            mean = lambda r: r[2] / r[1] if r else -1.0
            if before and after and before[0] == after[0]:
                name, power = before[0], max(before[3], after[3])
            elif before and mean(before) >= mean(after) or not after:
                name, power = before[0], mean(before)
            else:
                name, power = after[0], mean(after)
            count = runs_[k][1]
            runs_[k] = [name, count, count * power, power]
            first, last = k, k  # merged with the neighbours of its new label
            while first and runs_[first - 1][0] == name:
                first -= 1
            while last + 1 < len(runs_) and runs_[last + 1][0] == name:
                last += 1
            joined = runs_[first : last + 1]
            runs_[first : last + 1] = [[name, sum(r[1] for r in joined), sum(r[2] for r in joined), joined[0][3]]]
            k = first
        return pd.DataFrame({ENTITY: pdf[ENTITY], "idx": pdf["idx"], "label": [r[0] for r in runs_ for _ in range(r[1])]})

    return rows.groupBy(ENTITY).applyInPandas(settle, f"{ENTITY} long, idx int, label string")


def viterbi(rows: DataFrame, states: list[str], stay: float = 0.7, emit: float = 0.95, label: str = "label") -> DataFrame:
    """Labels smoothed by the most probable state path: staying, moving to any other state, and
    emitting the own label with the given probabilities. Rows: entity_id, idx, label."""

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        k, seen = len(states), np.array([states.index(x) if x in states else -1 for x in pdf[label]])
        move = np.full((k, k), np.log((1 - stay) / max(1, k - 1)))
        np.fill_diagonal(move, np.log(stay))
        out = np.full((len(seen), k), np.log((1 - emit) / max(1, k - 1)))
        known = np.flatnonzero(seen >= 0)
        out[known, seen[known]] = np.log(emit)
        best, back = out[0] - np.log(k), []
        for row in out[1:]:
            through = best[:, None] + move
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return pd.DataFrame({ENTITY: pdf[ENTITY], "idx": pdf["idx"], "label": [states[s] for s in reversed(path)]})

    return rows.groupBy(ENTITY).applyInPandas(smooth, f"{ENTITY} long, idx int, label string")


#: Chords of the smoothing, in order, and its probabilities: to stay, to go to any of the key's chords, to any other, and to be heard as what
#: it is, and as another; and the least confidence of a key that it is done for. Fixed values.
CHORDS = [name for pitch in PITCH_CLASSES for name in (pitch, f"{pitch}m")]
STAY, DIATONIC, CHROMATIC, HEARD, MISHEARD, KEY_CONFIDENCE = 0.7, 0.25, 0.05, 0.95, 0.05, 0.5


def chord_moves(tonic: int, major: bool) -> np.ndarray:
    """Log probabilities to go from a chord (row) to another (column) in a key."""
    inside = {PITCH_CLASSES[(tonic + step) % 12] + ends for step, ends in (MAJOR if major else MINOR)}
    to = np.array([np.log(DIATONIC / len(inside)) if c in inside else np.log(CHROMATIC / (len(CHORDS) - len(inside) - 1)) for c in CHORDS])
    moves = np.tile(to, (len(CHORDS), 1))
    np.fill_diagonal(moves, np.log(STAY))
    return moves


def smooth_chords(rows: DataFrame, keys: DataFrame, label: str = "label") -> DataFrame:
    """(entity_id, idx, label): the most probable path of chords through the labels of entities whose key (tonic 0 to 11, major, confidence) is known with
    confidence; all others, and single rows, keep their labels. Of equally probable chords the first counts. A label that is no such chord tells nothing. The
    path of an entity is one pandas call; of each row it holds one byte for each chord."""
    told = rows.select(ENTITY, "idx", F.col(label).alias("label")).join(keys.select(ENTITY, "tonic", "major", "confidence"), ENTITY, "left")
    sure = F.coalesce(F.col("confidence") >= KEY_CONFIDENCE, F.lit(False)) & F.col("tonic").isNotNull() & F.col("major").isNotNull()

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        if len(pdf) < 2:
            return pdf[[ENTITY, "idx", "label"]]
        moves, k = chord_moves(int(pdf["tonic"].iloc[0]), bool(pdf["major"].iloc[0])), len(CHORDS)
        place = {c: i for i, c in enumerate(CHORDS)}
        unheard = np.full(k, np.log(MISHEARD / (k - 1)))
        best, back = None, np.zeros((len(pdf), k), dtype=np.int8)
        for t, name in enumerate(pdf["label"]):
            heard = unheard.copy()
            if name in place:
                heard[place[name]] = np.log(HEARD)
            if best is None:
                best = heard
                continue
            through = best[:, None] + moves
            back[t] = through.argmax(axis=0)
            best = through.max(axis=0) + heard
        path = [int(best.argmax())]
        for t in range(len(pdf) - 1, 0, -1):
            path.append(int(back[t, path[-1]]))
        return pd.DataFrame({ENTITY: pdf[ENTITY], "idx": pdf["idx"], "label": [CHORDS[s] for s in reversed(path)]})

    kinds = {f.name: f.dataType.simpleString() for f in told.schema.fields}
    smoothed = told.where(sure).groupBy(ENTITY).applyInPandas(smooth, f"{ENTITY} {kinds[ENTITY]}, idx {kinds['idx']}, label string")
    return told.where(~sure).select(ENTITY, "idx", "label").unionByName(smoothed)


#: What a phrase must have in common with a group to join it: cosine, mean pitch, density and pitch classes. Fixed values.
LIKE, CENTROID_GAP, DENSITY_GAP, SHARED_CLASSES = 0.97, 4.5, 0.3, 2


def phrase_groups(windows_: DataFrame) -> DataFrame:
    """(entity_id, idx, group_idx): phrases (idx in order of time, bar_count, contour, centroid or null, density, classes, vector) grouped in order. Each joins the group, of its length and
    contour, near in mean pitch and density and with two pitch classes in common at least, whose running mean vector is most like its own, the
    earliest of equals; or starts a group, which is known by its first phrase. Groups of other lengths and contours never meet, so those are grouped apart."""

    def group(key: tuple, phrases: list[tuple]) -> list[tuple]:
        groups: list[dict] = []
        found = []
        for idx, pitch, density, classes, vector in phrases:
            vector, best, most = np.asarray(vector, dtype=float), None, 0.0
            own = np.linalg.norm(vector)
            pitch = None if pitch is None or np.isnan(pitch) else float(pitch)
            for g in groups:
                if g["centroid"] is not None and pitch is not None and abs(g["centroid"] - pitch) > CENTROID_GAP:
                    continue
                if abs(g["density"] - density) / max(g["density"], 1.0) > DENSITY_GAP or len(g["classes"].intersection(classes)) < SHARED_CLASSES:
                    continue
                norm = g["norm"] * own
                like = float(g["vector"] @ vector / norm) if norm > 0 else 0.0
                if like > most:
                    best, most = g, like
            if best is None or most < LIKE:
                best = {"first": idx, "n": 0, "vector": np.zeros_like(vector), "density": 0.0, "centroid": None, "classes": set(classes)}
                groups.append(best)
            n = best["n"]
            best["vector"] = (best["vector"] * n + vector) / (n + 1)
            best["norm"] = np.linalg.norm(best["vector"])
            best["density"] = (best["density"] * n + density) / (n + 1)
            if pitch is not None:
                best["centroid"] = pitch if best["centroid"] is None else (best["centroid"] * n + pitch) / (n + 1)
            best["n"] = n + 1
            found.append((key[0], idx, best["first"]))
        return found

    kinds = {f.name: f.dataType.simpleString() for f in windows_.schema.fields}
    told = windows_.select(ENTITY, "bar_count", "contour", "idx", "centroid", "density", "classes", "vector")
    return each_group(told, [ENTITY, "bar_count", "contour"], ["idx"], group, f"{ENTITY} {kinds[ENTITY]}, idx {kinds['idx']}, group_idx {kinds['idx']}")


def distinct_notes(notes: DataFrame, within: int, look_back: int = 12, pitch_gap: int = 1) -> DataFrame:
    """Notes (t, pitch, priority, confidence, event_id) without near repeats: in order of time,
    priority and falling confidence, a note within the time and pitch gap of one of the last
    ``look_back`` kept, the latest first, is dropped, or takes its place if of better priority, or
    equal and of higher confidence. Notes farther apart than ``within`` do not meet, so an entity is cut at such gaps, and its chunks are
    thinned apart."""

    def thin(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="chunk").sort_values(["t", "priority", "confidence", "event_id"], ascending=[True, True, False, True])
        kept: list[tuple] = []
        names = list(pdf.columns)
        t, p, r, c = (names.index(x) for x in ("t", "pitch", "priority", "confidence"))
        for note in pdf.itertuples(index=False, name=None):
            for k in range(len(kept) - 1, max(-1, len(kept) - 1 - look_back), -1):
                other = kept[k]
                if abs(other[t] - note[t]) <= within and abs(other[p] - note[p]) <= pitch_gap:
                    if note[r] < other[r] or note[r] == other[r] and note[c] > other[c]:
                        kept[k] = note
                    break
            else:
                kept.append(note)
        return pd.DataFrame(kept, columns=names).sort_values(["t", "pitch", "event_id"])

    return decided_chunks(notes, "t", within, ["t", "event_id"]).groupBy(ENTITY, "chunk").applyInPandas(thin, notes.schema)


def prototypes(vectors: DataFrame, least: float = 0.97, vector: str = "vector") -> DataFrame:
    """Vectors grouped in order: each joins the group of most similar running-mean prototype if the
    cosine reaches ``least``, else starts one. Rows: entity_id, idx, grp."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        means: list[np.ndarray] = []
        sizes: list[int] = []
        found = []
        for v in (np.asarray(x, dtype=float) for x in pdf[vector]):
            like = [float(m @ v / ((np.linalg.norm(m) * np.linalg.norm(v)) or 1.0)) for m in means]
            k = int(np.argmax(like)) if like else -1
            if k >= 0 and like[k] >= least:
                sizes[k] += 1
                means[k] = means[k] + (v - means[k]) / sizes[k]
            else:
                k = len(means)
                means.append(v)
                sizes.append(1)
            found.append(k + 1)
        return pd.DataFrame({ENTITY: pdf[ENTITY], "idx": pdf["idx"], "grp": found})

    return vectors.groupBy(ENTITY).applyInPandas(group, f"{ENTITY} long, idx int, grp int")
