"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text and binary that a task's Python turns into objects at once.
BATCH_BYTES = 4 << 20


def by_bytes(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text and binary, or one row where a row is larger.
    Spark bounds a batch by spark.sql.execution.arrow.maxBytesPerBatch, which leaves it large once it is
    Python objects."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            if start < end:
                yield batch.slice(start, end - start)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where that is unset, and there is but one machine,
    one of our own."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tempora-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        sc.setCheckpointDir(found)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost
    executor costs no recomputation before it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._tempora_path = path
    return back


def forget(df: DataFrame) -> None:
    """Delete the table behind a materialised DataFrame that nothing reads any more."""
    path = getattr(df, "_tempora_path", None)
    if path:
        delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions_for(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def need_columns(df: DataFrame, *names: str) -> DataFrame:
    """df's columns of these names only, so that further columns of any name cannot clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])
