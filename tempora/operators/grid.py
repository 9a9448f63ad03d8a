"""Grids: beats, bars, blocks, resampling and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENTITY = "entity_id"


def by_time(*order: str):
    return Window.partitionBy(ENTITY).orderBy(*(order or ("t", "event_id")))


def beats(points: DataFrame) -> DataFrame:
    """points (entity_id, t, event_id) numbered from 1, four to a bar, the first a downbeat."""
    n = F.row_number().over(by_time())
    return points.withColumn("idx", n).withColumns(
        {"bar": F.floor((F.col("idx") - 1) / 4).cast("int") + 1, "beat_in_bar": (F.col("idx") - 1) % 4 + 1, "downbeat": (F.col("idx") - 1) % 4 == 0}
    )


def bars(grid: DataFrame) -> DataFrame:
    """Bars from downbeat to downbeat; the last ends a median gap behind the last beat."""
    gaps = grid.withColumn("_gap", F.col("t") - F.lag("t").over(by_time()))
    tail = gaps.groupBy(ENTITY).agg(F.max("t").alias("_last"), F.coalesce(F.median("_gap"), F.lit(0.0)).alias("_median"))
    starts = grid.where("beat_in_bar = 1").select(ENTITY, "bar", F.col("t").alias("start_t"))
    ended = starts.withColumn("_next", F.lead("start_t").over(Window.partitionBy(ENTITY).orderBy("bar")))
    return ended.join(tail, ENTITY).select(ENTITY, "bar", "start_t", F.coalesce(F.col("_next").cast("double"), F.col("_last") + F.col("_median")).alias("end_t"))


def window_ends(grid: DataFrame, bar_ends: DataFrame) -> DataFrame:
    """End of each beat: the next beat, else its bar's end, else its own time."""
    following = F.lead("t").over(by_time())
    joined = grid.withColumn("_next", following).join(bar_ends.select(ENTITY, "bar", "end_t"), [ENTITY, "bar"], "left")
    return joined.withColumn("end_t", F.coalesce(F.col("_next").cast("double"), "end_t", F.col("t").cast("double"))).drop("_next")


def blocks(rows: DataFrame, size: int, values: list[str], least: int | None = None) -> DataFrame:
    """Runs of ``size`` rows in order, with first and last time, count and sums of values; a last block
    of fewer than ``least`` rows joins the one before."""
    least = least or 1
    numbered = rows.withColumns({"_n": F.row_number().over(by_time()) - 1, "_all": F.count("*").over(Window.partitionBy(ENTITY))})
    whole = F.floor(F.col("_all") / size)
    rest = F.col("_all") % size
    number = F.floor(F.col("_n") / size)
    block = F.when((number == whole) & (rest < least) & (whole > 0), whole - 1).otherwise(number).cast("int")
    sums = [F.sum(v).alias(f"{v}_sum") for v in values]
    return numbered.withColumn("block", block).groupBy(ENTITY, "block").agg(F.min("t").alias("start_t"), F.max("t").alias("last_t"), F.count("*").alias("n_rows"), *sums)


def resample(rows: DataFrame, step: int, values: list[str]) -> DataFrame:
    """A grid of ``step`` from each entity's first to last time, each point with the values of the
    nearest row, the earlier on a tie. Rows and points are merged in time order; nothing is paired."""
    span = rows.groupBy(ENTITY).agg(F.min("t").alias("_a"), F.max("t").alias("_b"))
    points = span.select(ENTITY, F.explode(F.sequence("_a", "_b", F.lit(step))).alias("t"))
    packed = F.struct(F.col("t").alias("at"), "event_id", *values)
    # of rows at one time the first counts: it is the last in backward order, so each side is asked apart
    firsts = rows.groupBy(ENTITY, "t").agg(F.min(packed).alias("row"))
    both = firsts.select(ENTITY, "t", "row", F.lit(0).alias("kind")).unionByName(points.select(ENTITY, "t", F.lit(None).cast(firsts.schema["row"].dataType).alias("row"), F.lit(1).alias("kind")))
    back = Window.partitionBy(ENTITY).orderBy("t", "kind")
    ahead = Window.partitionBy(ENTITY).orderBy(F.desc("t"), "kind")
    near = both.withColumns({"_p": F.last("row", True).over(back), "_n": F.last("row", True).over(ahead)}).where("kind = 1")
    pick = F.when(F.col("_n").isNull() | (F.col("t") - F.col("_p")["at"] <= F.col("_n")["at"] - F.col("t")), F.col("_p")).otherwise(F.col("_n"))
    return near.withColumn("_row", pick).select(ENTITY, F.col("t").alias("grid_t"), F.col("_row")["event_id"].alias("event_id"), *[F.col("_row")[v].alias(v) for v in values])


def bucket(rows: DataFrame, width: int, value: str, label: str | None = None) -> DataFrame:
    """Tumbling buckets of floor(t / width): largest value, count and, with a label, counts by it."""
    keyed = rows.withColumn("bucket", F.floor(F.col("t") / width))
    out = keyed.groupBy(ENTITY, "bucket").agg(F.max(value).alias("max_value"), F.count("*").alias("n"))
    if label:
        counts = keyed.groupBy(ENTITY, "bucket", label).agg(F.count("*").alias("c"))
        by = counts.groupBy(F.col(ENTITY).alias("_e"), F.col("bucket").alias("_b")).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", label, "c"))), ",").alias("by_label"))
        out = out.join(by, (F.col(ENTITY) == F.col("_e")) & (F.col("bucket") == F.col("_b"))).drop("_e", "_b")
    return out


def sliding(rows: DataFrame, size: int, step: int, aligned_last: bool = False) -> DataFrame:
    """Windows of ``size`` rows every ``step`` rows, each row once for each window it is in:
    the row's columns with ``window_start`` (0-based). Only whole windows; with aligned_last one
    more that ends at the last row, where the step misses it."""
    numbered = rows.withColumns({"_i": F.row_number().over(by_time()) - 1, "_n": F.count("*").over(Window.partitionBy(ENTITY))})
    first = F.greatest(F.lit(0), F.ceil((F.col("_i") - size + 1) / step)).cast("int")
    last = F.least(F.floor(F.col("_i") / step), F.floor((F.col("_n") - size) / step)).cast("int")
    starts = F.when((F.col("_n") >= size) & (first <= last), F.transform(F.sequence(first, last), lambda k: k * step)).otherwise(F.array().cast("array<int>"))
    if aligned_last:
        end = (F.col("_n") - size).cast("int")
        extra = F.when((F.col("_n") >= size) & (end % step != 0) & (F.col("_i") >= end), F.array(end)).otherwise(F.array().cast("array<int>"))
        starts = F.concat(starts, extra)
    return numbered.withColumn("window_start", F.explode(starts)).drop("_i", "_n")


def every_bar(grid: DataFrame, step: int | Column) -> DataFrame:
    """Bars shown at a zoom step: those whose number less one divides by it."""
    return grid.where((F.col("bar") - 1) % step == 0)
