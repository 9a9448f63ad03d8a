"""Dense blocks of features, for models that take a matrix of features by rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import ENTITY

#: Features that a table of keys may name; more point to values used as keys.
MOST_KEYS = 4096


def feature_keys(rows: DataFrame, maps: list[str], most: int = MOST_KEYS) -> list[tuple[str, str]]:
    """The (map, key) pairs that stand anywhere in rows, by the order of maps, then by key. Raises where there are more
    than ``most``."""

    def keys_of(place: int, name: str) -> Column:
        return F.transform(F.coalesce(F.map_keys(name), F.array().cast("array<string>")), lambda k: F.struct(F.lit(place).alias("place"), k.alias("key")))

    pairs = F.flatten(F.array(*[keys_of(n, m) for n, m in enumerate(maps)]))
    found = rows.select(F.explode(F.array_distinct(pairs)).alias("p")).select("p.*").distinct().orderBy("place", "key").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} features")
    return [(maps[r.place], r.key) for r in found]


def feature_blocks(rows: DataFrame, keys: list[tuple[str, str]], block_rows: int = 1024, time: str = "t") -> DataFrame:
    """(entity_id, block, first_idx, idx, times, values): rows (idx from 1, the maps) in blocks of at most ``block_rows`` rows, values[f][r] being
    feature f of the block's r-th row, as a float; 0 where a row lacks the key or its map. However long an entity is, a block is bounded.
    Repeated idx stand side by side."""
    value = [F.coalesce(F.try_element_at(F.col(m), F.lit(k)).cast("float"), F.lit(0.0).cast("float")) for m, k in keys]
    narrow = rows.select(ENTITY, F.floor((F.col("idx") - 1) / block_rows).cast("long").alias("block"), F.struct(F.col("idx").cast("long").alias("idx"), F.col(time).alias("time"), F.array(*value).cast("array<float>").alias("values")).alias("row"))
    blocks = narrow.groupBy(ENTITY, "block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    turned = F.transform(F.sequence(F.lit(0), F.lit(len(keys) - 1)), lambda k: F.transform("rows", lambda r: F.get(r["values"], k))) if keys else F.array().cast("array<array<float>>")
    return blocks.select(ENTITY, "block", (F.col("block") * block_rows + 1).alias("first_idx"), F.transform("rows", lambda r: r["idx"]).alias("idx"), F.transform("rows", lambda r: r["time"]).alias("times"), turned.alias("values"))
