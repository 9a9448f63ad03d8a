"""Joins of points and intervals within an entity.

Nearest and as-of lookups are one sort: both sides are merged in time order and each point takes
the last or next row of the other side by window, so nothing is paired. Range joins are equi-joins
on (entity, time bucket), an interval being listed in each bucket it touches; with a bucket width
near the interval length that is about two buckets.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import overlap, overlap_ratio
from .windows import decided_chunks, each_group

ENTITY = "entity_id"


def _packed(df: DataFrame, time: str) -> Column:
    return F.struct(F.col(time).alias("_at"), *[F.col(c) for c in df.columns if c not in (ENTITY, time)])


def neighbours(points: DataFrame, grid: DataFrame, time: str = "t", grid_time: str = "t", order: tuple[str, ...] = ()) -> DataFrame:
    """points with ``prev`` and ``next``: the grid rows at or before and at or after them, as structs
    with ``_at``. Of grid rows at one time the first by ``order`` counts."""
    row = _packed(grid, grid_time)
    firsts = grid.groupBy(ENTITY, F.col(grid_time).alias("_t")).agg(F.min_by(row, F.struct(*order)) if order else F.min(row).alias("_row"))
    firsts = firsts.toDF(ENTITY, "_t", "_row")
    point = F.struct(*[F.col(c) for c in points.columns])
    both = firsts.select(ENTITY, "_t", "_row", F.lit(None).cast(points.select(point.alias("p")).schema["p"].dataType).alias("_p"), F.lit(0).alias("_k")).unionByName(
        points.select(ENTITY, F.col(time).alias("_t"), F.lit(None).cast(firsts.schema["_row"].dataType).alias("_row"), point.alias("_p"), F.lit(1).alias("_k"))
    )
    back = Window.partitionBy(ENTITY).orderBy("_t", "_k")
    ahead = Window.partitionBy(ENTITY).orderBy(F.desc("_t"), "_k")
    return both.withColumns({"prev": F.last("_row", True).over(back), "next": F.last("_row", True).over(ahead)}).where("_k = 1").select("_p.*", "prev", "next")


def nearest(points: DataFrame, grid: DataFrame, tolerance: int | None = None, later: bool = False, time: str = "t", grid_time: str = "t", order: tuple[str, ...] = ()) -> DataFrame:
    """points with ``near``, the nearest grid row, and ``delta``, the point's time less its. On a tie
    the earlier row, or with ``later`` the later. Beyond the tolerance near is null; delta stays."""
    both = neighbours(points, grid, time, grid_time, order)
    before, after = F.col(time) - F.col("prev._at"), F.col("next._at") - F.col(time)
    back = (before < after) if later else (before <= after)
    near = F.when(F.col("next").isNull() | (F.col("prev").isNotNull() & back), F.col("prev")).otherwise(F.col("next"))
    out = both.withColumn("near", near).withColumn("delta", F.col(time) - F.col("near._at")).drop("prev", "next")
    return out if tolerance is None else out.withColumn("near", F.when(F.abs("delta") <= tolerance, F.col("near")))


def as_of(points: DataFrame, states: DataFrame, time: str = "t", state_time: str = "t", fallback_first: bool = False, order: tuple[str, ...] = ()) -> DataFrame:
    """points with ``state``, the latest state at or before them; with fallback_first the first
    state for points before all."""
    both = neighbours(points, states, time, state_time, order).withColumnRenamed("prev", "state").drop("next")
    if fallback_first:
        row = _packed(states, state_time)
        first = states.groupBy(ENTITY).agg(F.min_by(row, F.col(state_time)).alias("_first"))
        both = both.join(first, ENTITY, "left").withColumn("state", F.coalesce("state", "_first")).drop("_first")
    return both


def containing(points: DataFrame, intervals: DataFrame, time: str = "t", start: str = "start_t", end: str = "end_t", fallback_last: bool = False) -> DataFrame:
    """points with ``inside``, the interval start <= t < end of intervals that do not overlap, as a
    struct; null in gaps. With fallback_last, points at or after the last interval's start that are in none
    get the last."""
    both = as_of(points, intervals, time, start).withColumn("_hit", F.col("state")[end] > F.col(time))
    if fallback_last:
        last = intervals.groupBy(ENTITY).agg(F.max(start).alias("_last"))
        both = both.join(last, ENTITY, "left").withColumn("_hit", F.col("_hit") | (F.col("state._at") == F.col("_last"))).drop("_last")
    return both.withColumn("inside", F.when(F.col("_hit"), F.col("state"))).drop("state", "_hit")


#: Buckets that one interval of a range join may touch; beyond, the width does not suit the intervals.
MOST_BUCKETS = 100_000


def _buckets(start: Column, until: Column, width: int) -> Column:
    """The buckets from start to until; an error where they are more than ``MOST_BUCKETS``."""
    first, last = F.floor(start / width), F.floor(until / width)
    many = F.raise_error(F.format_string("an interval touches %d buckets of a range join: take a larger width", last - first + 1)).cast("array<bigint>")
    return F.when(last - first >= MOST_BUCKETS, many).otherwise(F.sequence(first, last))


def in_range(rows: DataFrame, intervals: DataFrame, width: int, time: str = "t", start: str = "start_t", end: str = "end_t", closed: bool = False) -> DataFrame:
    """Rows paired with each interval start <= t < end (or <= with closed) of their entity; the
    intervals may overlap. Columns of both sides; names must not clash but for the entity."""
    until = F.col(end) if closed else F.col(end) - 1
    spread = intervals.where(F.col(start) <= until).withColumn("_bucket", F.explode(_buckets(F.col(start), until, width)))
    keyed = rows.withColumn("_bucket", F.floor(F.col(time) / width))
    return keyed.join(spread, [ENTITY, "_bucket"]).where((F.col(time) >= F.col(start)) & (F.col(time) <= until)).drop("_bucket")


def overlapping(a: DataFrame, b: DataFrame, width: int, a_start: str = "a_start", a_end: str = "a_end", b_start: str = "b_start", b_end: str = "b_end") -> DataFrame:
    """Pairs of intervals that share some length, with ``shared``. Each pair is made once: in the
    bucket in which the later of the two starts lies."""

    def spread(df: DataFrame, start: str, end: str) -> DataFrame:
        return df.where(F.col(end) > F.col(start)).withColumn("_bucket", F.explode(_buckets(F.col(start), F.col(end) - 1, width)))

    pairs = spread(a, a_start, a_end).join(spread(b, b_start, b_end), [ENTITY, "_bucket"])
    shared = overlap(F.col(a_start), F.col(a_end), F.col(b_start), F.col(b_end))
    once = F.col("_bucket") == F.floor(F.greatest(a_start, b_start) / width)
    return pairs.where(once).withColumn("shared", shared).where("shared > 0").drop("_bucket")


def coverage(windows: DataFrame, notes: DataFrame, width: int, key: str = "a_id") -> DataFrame:
    """Share of each window that notes cover, summed over notes and at most 1; 0 where none does."""
    pairs = overlapping(windows, notes, width)
    total = pairs.groupBy(ENTITY, key).agg(F.sum("shared").alias("_s"))
    length = F.col("a_end") - F.col("a_start")
    return windows.join(total, [ENTITY, key], "left").withColumn("score", F.when(length <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.coalesce(F.col("_s"), F.lit(0)) / length))).drop("_s")


def best_overlap(a: DataFrame, b: DataFrame, width: int, least: float = 0.5, label: str = "label") -> DataFrame:
    """Each interval of a (a_id, a_start, a_end, a_label) with the interval of b that covers most of
    it, the first by start on a tie, and ``result``: missing, short, differs or match."""
    pairs = overlapping(a, b, width)
    best = pairs.groupBy(ENTITY, "a_id").agg(F.max_by(F.struct("b_id", "b_label", "shared"), F.struct("shared", -F.col("b_start"), -F.col("b_id"))).alias("_best"))
    ratio = F.col("_best.shared") / (F.col("a_end") - F.col("a_start"))
    result = F.when(F.col("_best").isNull(), "missing").when(ratio < least, "short").when(F.col("_best.b_label") != F.col("a_label"), "differs").otherwise("match")
    return a.join(best, [ENTITY, "a_id"], "left").withColumns({"b_id": F.col("_best.b_id"), "ratio": F.coalesce(ratio, F.lit(0.0)), "result": result}).drop("_best")


def first_overlap(a: DataFrame, b: DataFrame, width: int) -> DataFrame:
    """Each interval of a with the first interval of b, by start, that shares some of it, or null."""
    pairs = overlapping(a, b, width).groupBy(ENTITY, "a_id").agg(F.min_by("b_id", F.struct("b_start", "b_id")).alias("b_id"))
    return a.join(pairs, [ENTITY, "a_id"], "left")


def greedy_matches(expected: DataFrame, actual: DataFrame, tolerance: int) -> DataFrame:
    """One-to-one matches of typed intervals (id, type, start_t, end_t) within an entity, expected
    ones in time order: of unused actual ones of the type that start or end within the tolerance,
    the one of best overlap ratio, the first on a tie. Rows: entity_id, expected_id, actual_id;
    either is null for a miss or a false positive; an interval without a start or an end matches none. Each choice depends on those before, but not
    across a stretch of more than the tolerance in which nothing is: an entity is cut there, and its chunks are matched apart."""

    def match(key, rows):
        used, out = set(), []
        actuals = [r for r in rows if not r[-1]]
        # of each type, places in order of start and in order of end
        by_start, by_end = {}, {}
        for i, (_, kind, start, end, _) in enumerate(actuals):
            if start is not None and end is not None:
                by_start.setdefault(kind, []).append((start, i))
                by_end.setdefault(kind, []).append((end, i))
        for ends in by_end.values():
            ends.sort()
        for id_, kind, start, end, _ in (r for r in rows if r[-1]):
            near = set()
            for listed, at in ((by_start.get(kind, []), start), (by_end.get(kind, []), end)) if start is not None and end is not None else ():
                near.update(i for _, i in listed[bisect_left(listed, (at - tolerance, -1)) : bisect_right(listed, (at + tolerance, len(actuals)))])
            best, most = None, -1.0
            for other, _, a, b, _ in (actuals[i] for i in sorted(near)):
                if other in used:
                    continue
                longer = max(b - a, end - start)
                ratio = max(0, min(b, end) - max(a, start)) / longer if longer > 0 else 0.0
                if ratio > most:
                    best, most = other, ratio
            if best is not None:
                used.add(best)
            out.append((key[0], id_, best))
        return out + [(key[0], None, r[0]) for r in actuals if r[0] not in used]

    both = _apart(expected, actual, tolerance, ["start_t", "id"], "end_t").select(ENTITY, "chunk", "id", "type", "start_t", "end_t", "_left")
    return each_group(both, [ENTITY, "chunk"], ["start_t", "id"], match, f"{ENTITY} long, expected_id long, actual_id long")


def _apart(left: DataFrame, right: DataFrame, tolerance: int, by: list[str], end: str) -> DataFrame:
    """Rows of both sides, ``_left`` telling which, with the chunk that they lie in together."""
    both = left.withColumn("_left", F.lit(True)).unionByName(right.select(left.columns).withColumn("_left", F.lit(False)))
    return decided_chunks(both, end, tolerance, by)


def match_boundaries(reference: DataFrame, inferred: DataFrame, tolerance: int) -> DataFrame:
    """Two sorted boundary lists (t) walked together: match within the tolerance, else the earlier
    is missed (reference) or extra (inferred), as is a boundary without a time. The first boundary of each side is dropped. An entity is cut where nothing is for more than
    the tolerance, and its chunks are walked apart."""

    def walk(key, rows):
        entity = key[0]
        a, b, i, j = [t for t, left in rows if left and t is not None], [t for t, left in rows if not left and t is not None], 0, 0
        out = [(entity, "missed" if left else "extra", None, None) for t, left in rows if t is None]
        while i < len(a) or j < len(b):
            if i < len(a) and j < len(b) and abs(a[i] - b[j]) <= tolerance:
                out.append((entity, "match", a[i], b[j]))
                i, j = i + 1, j + 1
            elif j >= len(b) or (i < len(a) and a[i] < b[j]):
                out.append((entity, "missed", a[i], None))
                i += 1
            else:
                out.append((entity, "extra", None, b[j]))
                j += 1
        return out

    later = lambda df: df.select(ENTITY, "t", F.row_number().over(Window.partitionBy(ENTITY).orderBy(F.asc_nulls_last("t"))).alias("_n")).where("_n > 1").drop("_n")
    both = _apart(later(reference), later(inferred), tolerance, ["t"], "t").select(ENTITY, "chunk", "t", "_left")
    return each_group(both, [ENTITY, "chunk"], ["t"], walk, f"{ENTITY} long, result string, reference_t long, inferred_t long")


__all__ = ["as_of", "best_overlap", "containing", "coverage", "first_overlap", "greedy_matches", "in_range", "match_boundaries", "nearest", "neighbours", "overlap_ratio", "overlapping"]
