"""Window functions along a timeline."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENTITY = "entity_id"
_ARROW = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}


def order(*by: str):
    return Window.partitionBy(ENTITY).orderBy(*(by or ("idx",)))


def delta(x: str) -> Column:
    """Difference to the row before; 0 in the first."""
    return F.coalesce(F.col(x) - F.lag(x).over(order()), F.lit(0))


def trailing_mean(x: str, rows: int) -> Column:
    """Mean of the last ``rows`` rows, this one included. Of integers it is one exact division."""
    w = order().rowsBetween(-(rows - 1), 0)
    return F.sum(x).over(w) / F.count(x).over(w)


def trailing_means(rows: DataFrame, means: dict[str, tuple[str, int]]) -> DataFrame:
    """rows with means of whole numbers over the last rows, this one included, rounded to whole numbers: name -> (column, rows). Each is the
    difference of two running sums, so its cost does not grow with the number of rows."""
    w = order()
    summed = {f"_s_{x}": F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, 0)) for x in dict.fromkeys(x for x, _ in means.values())}
    counted = {f"_n_{x.removeprefix('_s_')}": F.count(x.removeprefix("_s_")).over(w.rowsBetween(Window.unboundedPreceding, 0)) for x in summed}
    last = lambda c, n: F.coalesce(F.col(c), F.lit(0)) - F.coalesce(F.lag(c, n).over(w), F.lit(0))
    added = rows.withColumns(summed | counted)
    return added.withColumns({name: F.round(F.try_divide(last(f"_s_{x}", n), last(f"_n_{x}", n))).cast("long") for name, (x, n) in means.items()}).drop(*summed, *counted)


def silence(rows: DataFrame, count: Column, length: Column) -> DataFrame:
    """rows with ``gap``: the lengths added up since the count was last above 0, this row included;
    0 in rows with a count."""
    marked = rows.withColumn("_island", F.sum(F.when(count > 0, 1).otherwise(0)).over(order()))
    inside = Window.partitionBy(ENTITY, "_island").orderBy("idx")
    return marked.withColumn("gap", F.sum(F.when(count > 0, F.lit(0)).otherwise(length)).over(inside)).drop("_island")


def changed(x: str) -> Column:
    """1 where the label differs from the row before; 0 in the first."""
    before = F.lag(x).over(order())
    return F.when(F.row_number().over(order()) == 1, 0).when(~before.eqNullSafe(F.col(x)), 1).otherwise(0)


def peak(x: str) -> Column:
    """At least the row before, above the row after; the first and last row are none."""
    return F.coalesce((F.col(x) >= F.lag(x).over(order())) & (F.col(x) > F.lead(x).over(order())), F.lit(False))


def extremum(x: str, radius: int = 4, low: bool = False) -> Column:
    """No row within the radius is beyond this one."""
    w = order().rowsBetween(-radius, radius)
    return F.col(x) == (F.min(x) if low else F.max(x)).over(w)


def decided_chunks(rows: DataFrame, end: str, tolerance: int, by: list[str], size: int = 2000) -> DataFrame:
    """rows with ``chunk``: rows of an entity in the order of ``by`` (the start first), cut where one starts more than the tolerance after all
    before it have ended, so that no choice among nearby rows reaches across a cut. A chunk takes on stretches until it has ``size`` rows; a longer
    stretch stays whole."""
    w = order(*by)
    placed = rows.withColumns({"_reach": F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), "_rank": F.row_number().over(w)})
    cut = F.col("_reach").isNull() | (F.col(by[0]) > F.col("_reach") + tolerance)
    headed = placed.withColumn("_head", F.when(cut, F.col("_rank"))).withColumn("_head", F.last("_head", True).over(w))
    return headed.withColumn("chunk", F.floor(F.col("_head") / size)).drop("_reach", "_rank", "_head")


def each_group(rows: DataFrame, keys: list[str], by: list[str], work: Callable[[tuple, list[tuple]], list[tuple]], schema: str, size: int = 10_000) -> DataFrame:
    """What ``work`` makes of each group of rows with equal keys: it takes the keys and the rows' other columns in the order of ``by``. One shuffle by
    the keys; a task streams its sorted rows and holds one group, where a grouped pandas function costs milliseconds for each of the many small ones.
    A shuffle compares keys as a grouping does, nulls being equal."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = rows.select(*keys, *[c for c in rows.columns if c not in keys]).repartition(n, *keys).sortWithinPartitions(*keys, *by)
    k, out = len(keys), pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in schema.split(", "))])
    batch_of = lambda made: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), out, strict=True)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        made: list[tuple] = []
        for key, group in groupby(flat, lambda row: row[:k]):
            made += work(key, [row[k:] for row in group])
            if len(made) >= size:
                yield batch_of(made)
                made = []
        if made:
            yield batch_of(made)

    return dealt.mapInArrow(run, schema)


def entity_quantiles(rows: DataFrame, x: str, tenths: list[int]) -> DataFrame:
    """rows with q1, q9 and so on: quantiles in tenths of each entity's integer values, linearly
    interpolated, in tenths of the unit, so exact integers."""
    whole = Window.partitionBy(ENTITY)
    placed = rows.withColumns({"_rank": F.row_number().over(Window.partitionBy(ENTITY).orderBy(x)) - 1, "_n": F.count("*").over(whole)})
    for q in tenths:
        place = (F.col("_n") - 1) * q
        part = F.when(F.col("_rank") == F.floor(place / 10), F.col(x) * (10 - place % 10)).when(F.col("_rank") == F.floor(place / 10) + 1, F.col(x) * (place % 10))
        placed = placed.withColumn("_part", part).withColumn(f"q{q}", F.sum("_part").over(whole)).drop("_part")
    return placed.drop("_rank", "_n")


def accents(rows: DataFrame, x: str, rise: int) -> DataFrame:
    """rows with ``kind``: peak (ends stand in for missing neighbours), rise (upper quantile and a
    rise of that much), or null."""
    before, after = F.coalesce(F.lag(x).over(order()), F.col(x)), F.coalesce(F.lead(x).over(order()), F.col(x))
    flat = F.col(x)
    marked = entity_quantiles(rows.withColumns({"_b": before, "_a": after}), x, [9])
    return marked.withColumn("kind", F.when((flat > F.col("_b")) & (flat >= F.col("_a")), "peak").when((flat * 10 >= F.col("q9")) & (flat - F.col("_b") >= rise), "rise")).drop("_b", "_a", "q9")


def contrast(rows: DataFrame, values: list[str], reach: int = 4) -> DataFrame:
    """rows with ``contrast``: distance between the means of the ``reach`` rows before and of those from here on;
    null within reach of the ends."""
    back, ahead = order().rowsBetween(-reach, -1), order().rowsBetween(0, reach - 1)
    parts = [(F.sum(v).over(ahead) / reach - F.sum(v).over(back) / reach) for v in values]
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    first = values[0]
    return rows.withColumn("contrast", F.when((F.count(first).over(back) == reach) & (F.count(first).over(ahead) == reach), F.sqrt(total)))


def refine(rows: DataFrame, starts: DataFrame, reach: int = 4, penalty: float = 0.12, gain: float = 0.03) -> DataFrame:
    """starts (entity_id, idx) moved to the row within reach of best ``contrast`` less a penalty for
    each row moved, if that gains enough; on a tie the nearer, then the later."""
    offered = starts.withColumn("_step", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("_at", F.col("idx") + F.col("_step"))
    scored = offered.join(rows.select(ENTITY, F.col("idx").alias("_at"), "contrast"), [ENTITY, "_at"]).where("contrast is not null").withColumn("_score", F.col("contrast") - penalty * F.abs("_step"))
    best = scored.groupBy(ENTITY, "idx").agg(F.max_by("_step", F.struct("_score", -F.abs("_step"), "_step")).alias("_step"), F.max("_score").alias("_top"), F.max(F.when(F.col("_step") == 0, F.col("_score"))).alias("_own"))
    moved = F.when(F.col("_top") >= F.coalesce("_own", F.lit(float("-inf"))) + gain, F.col("_step")).otherwise(0)
    return starts.join(best, [ENTITY, "idx"], "left").withColumn("refined_idx", F.col("idx") + F.coalesce(moved, F.lit(0))).drop("_step", "_top", "_own")


def numbered(rows: DataFrame, by: list[str], prefix: str = "", digits: int = 3) -> DataFrame:
    """rows with ``number`` in their group and ``number_id``, the prefix and padded number."""
    n = F.row_number().over(Window.partitionBy(ENTITY, *by).orderBy("t", "event_id"))
    return rows.withColumn("number", n).withColumn("number_id", F.concat(F.lit(prefix), *[F.concat(F.col(c), F.lit("_")) for c in by], F.format_string(f"%0{digits}d", "number")))
