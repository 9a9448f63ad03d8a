"""Artifacts that later runs take up again.

An artifact is known by its name, the files it was made from (path, length, time of change), its parameters and the
code that made it. Its data are written to a folder of their own, and then a manifest that lists every data file with
its length: the commit. A run that finds the manifest and all its files whole reads them; anything else is torn, and is made again.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .tables import artifact_dir

MANIFEST = "_MANIFEST.json"
#: Java never compiles methods of more bytes of code than this.
HUGE_METHOD = "8000"


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Within it, steps whose generated code Java would only interpret, as those of rows of many columns, run without whole-stage code."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, HUGE_METHOD)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Store:
    """Files by Hadoop's file systems, from the driver; lists and small manifests only."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def at(self, path: str):
        target = self.jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.conf), target

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """(path, length, time of change) of all files under a path, in path order; hidden ones (as of checksums) aside."""
        fs, target = self.at(path)
        if not fs.exists(target):
            return []
        found, walk = [], fs.listFiles(target, True)
        while walk.hasNext():
            status = walk.next()
            if not status.getPath().getName().startswith(("_", ".")):
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        return sorted(found)

    def read(self, path: str) -> str | None:
        """A small file's text; None where it is not there or cannot be read."""
        fs, target = self.at(path)
        try:
            if not fs.exists(target):
                return None
            stream = fs.open(target)
            try:
                return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
        except Py4JJavaError:  # as where its checksum is wrong
            return None

    def write(self, path: str, text: str) -> None:
        """Whole or not at all: written beside and renamed."""
        fs, target = self.at(path)
        _, beside = self.at(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not fs.rename(beside, target):  # another run was first
            fs.delete(beside, False)

    def delete(self, path: str) -> None:
        fs, target = self.at(path)
        fs.delete(target, True)


def code_of(*modules: ModuleType) -> str:
    """A digest of modules' source, so that changed code makes artifacts anew."""
    return hashlib.sha256("\0".join(inspect.getsource(m) for m in modules).encode()).hexdigest()


def committed(store: Store, folder: str) -> dict | None:
    """The manifest of an artifact whose files are all there in their lengths, else None."""
    text = store.read(f"{folder}/{MANIFEST}")
    try:
        manifest = json.loads(text) if text else None
    except json.JSONDecodeError:
        return None
    if manifest is None:
        return None
    there = {path.rpartition("/")[2]: length for path, length, _ in store.files(f"{folder}/{manifest['data']}")}
    return manifest if there == manifest["files"] and all(n > 0 for n in there.values()) else None


def reusable(spark: SparkSession, name: str, make: Callable[[], DataFrame], inputs: list[str], params: dict | None = None, force: bool = False) -> DataFrame:
    """The artifact of this name, inputs and parameters: read where a run has left it whole, else made, committed and read. ``make`` is
    called only where it is made. An input that is absent counts as empty."""
    store = Store(spark)
    key = hashlib.sha256(json.dumps([name, [store.files(p) for p in inputs], params or {}], sort_keys=True, default=str).encode()).hexdigest()[:32]
    folder = f"{artifact_dir(spark)}/{name}-{key}"
    found = None if force else committed(store, folder)
    if found is None:
        store.delete(f"{folder}/{MANIFEST}")
        data, df = f"data-{uuid.uuid4().hex}", make()
        with small_methods(spark):
            df.write.parquet(f"{folder}/{data}")
        files = {path.rpartition("/")[2]: length for path, length, _ in store.files(f"{folder}/{data}")}
        store.write(f"{folder}/{MANIFEST}", json.dumps({"name": name, "data": data, "files": files, "schema": json.loads(df.schema.json()), "params": params or {}}, default=str))
        found = committed(store, folder) or {"data": data, "schema": json.loads(df.schema.json())}
    return spark.read.schema(StructType.fromJson(found["schema"])).parquet(f"{folder}/{found['data']}")
