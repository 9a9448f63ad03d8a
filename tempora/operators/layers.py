"""Layers over several tracks: anchors, callbacks and section cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import reports
from .joins import containing
from .windows import ENTITY


def anchors(tracks: dict[str, DataFrame], time: str = "t", key: str = "event_id") -> DataFrame:
    """Points of all tracks in one list: entity_id, kind, t, key, and number in time order."""
    out = None
    for kind, df in tracks.items():
        part = df.select(ENTITY, F.lit(kind).alias("kind"), F.col(time).alias("t"), F.col(key).alias("source_id"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("number", F.row_number().over(Window.partitionBy(ENTITY).orderBy("t", "kind", "source_id")))


def callbacks(occurrences: DataFrame, pattern: str = "pattern", start: str = "start_t", key: str = "event_id") -> DataFrame:
    """Occurrences numbered within their pattern; the first establishes it, later ones repeat."""
    n = F.row_number().over(Window.partitionBy(ENTITY, pattern).orderBy(start, key))
    return occurrences.withColumn("occurrence", n).withColumn("action", F.when(F.col("occurrence") == 1, "establish").otherwise("repeat"))


def section_cards(rows: DataFrame, sections: DataFrame, value: str = "energy") -> DataFrame:
    """For each section: rows, mean, peak, its most frequent label and change of mean to the section before."""
    joined = containing(rows, sections).where("inside is not null").withColumn("section", F.col("inside.section"))
    cards = joined.groupBy(ENTITY, "section").agg(F.count("*").alias("n"), (F.sum(value) / F.count(value)).alias("mean"), F.max(value).alias("peak"))
    return cards.withColumn("change", F.coalesce(F.col("mean") - F.lag("mean").over(Window.partitionBy(ENTITY).orderBy("section")), F.lit(0.0)))


def accents_in(windows: DataFrame, accents: DataFrame, width: int, most: int = 6) -> DataFrame:
    """The first accents in each window, both ends included: window_id, accents in order."""
    return reports.first_in_windows(accents, windows, width, "window_id", most, "accents")


def refined_union(lists: list[DataFrame], key: list[str]) -> DataFrame:
    """Event lists joined; of rows with one key, that of the earliest list stays."""
    out = None
    for rank, df in enumerate(lists):
        part = df.withColumn("_rank", F.lit(rank))
        out = part if out is None else out.unionByName(part)
    first = Window.partitionBy(*key).orderBy("_rank", "event_id")
    return out.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_rank")
