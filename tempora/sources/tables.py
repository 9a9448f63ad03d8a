"""Timeline tables from Parquet, JSON and files, and their sinks."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Schemas of the JSON documents that rows are read from.
LYRICS = "line_id string, text string, start double, end double, confidence double"
HINTS = "id string, title string, start_time double, end_time double, summary string, lighting_hint string"
ANNOTATIONS = "annotation_status string, events array<struct<type: string, start_time: double, end_time: double, human_label: string>>"
SEGMENTS = "start double, end double, label string"
REFERENCE_BEATS = "curr_beat_time double, bar_num int, beat_num int, chord_simple_pop string, chord_basic_pop string, prev_chord string"


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a timeline: entity_id, event_id, t (microseconds), idx (1-based place),
    bar and beat_in_bar (four to a bar), label, energy (integer hundredths), k (from JSON props)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    order = Window.partitionBy("entity_id").orderBy("t", "event_id")
    rows = events.select(
        F.col("user_id").alias("entity_id"),
        "event_id",
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)").alias("t"),
        F.col("event_type").alias("label"),
        F.round(F.col("value") * 100).cast("long").alias("energy"),
        F.from_json("props", "k int")["k"].alias("k"),
    ).withColumn("idx", F.row_number().over(order))
    return rows.withColumns({"bar": F.floor((F.col("idx") - 1) / 4).cast("int") + 1, "beat_in_bar": (F.col("idx") - 1) % 4 + 1})


def read_json_rows(spark: SparkSession, path: str, schema: str, glob: str = "*.json") -> DataFrame:
    """Rows of JSON documents with their entity, the file's stem; an absent path has no rows."""
    try:
        rows = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", glob).json(path)
        return rows.withColumn("entity_id", entity_of(F.input_file_name()))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, entity_id string")


def reference_boundaries(segments: DataFrame) -> DataFrame:
    """(entity_id, t, label): where reference segments (start in seconds, label) begin, in microseconds, but for the first of each entity."""
    placed = segments.withColumn("_n", F.row_number().over(Window.partitionBy("entity_id").orderBy("start")))
    return placed.where("_n > 1").select("entity_id", F.round(F.col("start") * 1_000_000).cast("long").alias("t"), "label")


def entity_of(path: Column) -> Column:
    """The stem of a file name."""
    return F.regexp_extract(F.url_decode(path), r"([^/]+?)(?:\.[^./]*)?$", 1)


def artifact_dir(spark: SparkSession) -> str:
    """The folder of artifact tables: spark.checkpoint.dir, which all executors share. Where that is unset, a
    temporary one, but only in local mode, where there is one machine."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tempora-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def artifact(df: DataFrame, name: str) -> DataFrame:
    """df written as a table of its own and read back, so that what several steps read is computed once, and a
    lost executor costs nothing before it."""
    path = f"{artifact_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discover(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Files of a suffix, in any case, in path order: path, entity_id, length."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return found.where(F.lower("path").endswith(f".{suffix.lower()}")).withColumn("entity_id", entity_of(F.col("path"))).orderBy("path")


def reviewed_annotations(documents: DataFrame) -> DataFrame:
    """Annotation rows of the documents whose status is reviewed."""
    return documents.where("annotation_status = 'reviewed'").select("entity_id", F.inline("events"))


def write_json(df: DataFrame, path: str, entity: str = "entity_id") -> None:
    """One folder for each entity; numbers rounded to six digits, as only exports are."""
    rounded = df.withColumns({n: F.round(n, 6) for n, kind in df.dtypes if kind == "double"})
    rounded.write.mode("overwrite").partitionBy(entity).json(path)


def manifest(tables: dict[str, DataFrame], entity: str = "entity_id") -> DataFrame:
    """Row counts of every table for each entity: entity, artifact, rows."""
    counts = [df.groupBy(entity).agg(F.count("*").alias("rows")).select(entity, F.lit(name).alias("artifact"), "rows") for name, df in tables.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def markdown_lines(df: DataFrame, columns: list[str], order: list[str], entity: str = "entity_id") -> DataFrame:
    """A Markdown table for each entity, as one text: heading, rule and a line for each row."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in columns]), F.lit(" |"))
    head = "| " + " | ".join(columns) + " |\n|" + " --- |" * len(columns)
    lines = F.array_sort(F.collect_list(F.struct(*order, cells.alias("_line"))))
    return df.groupBy(entity).agg(F.concat(F.lit(head + "\n"), F.array_join(F.transform(lines, lambda x: x["_line"]), "\n")).alias("markdown"))
