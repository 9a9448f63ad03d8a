"""Media columns: payloads in archive directories, read by a Spark data source.

Payload bytes are stored losslessly as 8-bit greyscale PNG images, 64 samples a row, in tar
archives, one or more for each Spark partition, with a sidecar index of fixed-width entries. The
data source ``media_archive`` plans byte ranges over the archives of a directory; a task finds
the members that start in its range in the sidecar (or by walking the tar headers where there is
none), reads each by its offset, trying a member that fails again by itself, and streams payloads
as Arrow batches of bounded size.

Defined cases: null text is empty; an empty payload becomes 64 zero bytes; a null doc_id is
stored under the name ``null`` and reads back as null. Equal texts have equal stored forms.
Repeated rows and equal doc_ids are members of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import by_bytes, materialise, need_columns, new_path
from .files import AtomicFile, at

WIDTH = 64
LEVEL = 6
#: An archive is closed beyond this size.
ARCHIVE_BYTES = 256 << 20
#: Archive bytes of one read task, payload bytes of one Arrow batch, tries of one member.
RANGE_BYTES, BATCH_BYTES, TRIES = 8 << 20, 4 << 20, 3
#: Sidecar entries: header offset, data offset, data length, CRC-32 of the data.
ENTRY, ENTRY_BYTES = "<QQQI", struct.calcsize("<QQQI")
MAGIC = b"\x89PNG\r\n\x1a\n"

SCHEMA = "archive string, member string, offset long, media binary, error string"
ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary()), ("error", pa.string())])
FEATURES = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, n_bytes: int) -> bytes:
    """A greyscale PNG of WIDTH columns; payload must be a positive multiple of WIDTH. The number
    of bytes before padding is kept in a text chunk."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), dtype=np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return MAGIC + chunk(b"IHDR", head) + chunk(b"tEXt", b"n_bytes\0%d" % n_bytes) + chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + chunk(b"IEND", b"")


def decode_png(media: bytes) -> tuple[bytes, int]:
    """Payload and unpadded size of an image written by encode_png; ValueError if it is damaged."""
    if media[:8] != MAGIC:
        raise ValueError("not a PNG")
    at_, size, data, width, height = 8, 0, b"", 0, 0
    while at_ < len(media):
        (length,) = struct.unpack_from(">I", media, at_)
        kind, body = media[at_ + 4 : at_ + 8], media[at_ + 8 : at_ + 8 + length]
        if struct.unpack_from(">I", media, at_ + 8 + length)[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk does not have its checksum")
        if kind == b"IHDR":
            width, height = struct.unpack_from(">II", body)
        elif kind == b"tEXt" and body.startswith(b"n_bytes\0"):
            size = int(body[8:])
        elif kind == b"IDAT":
            data += body
        at_ += 12 + length
    lines = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("a row filter that the encoder does not use")
    return lines[:, 1:].tobytes(), size


def tar_header(name: str, size: int) -> bytes:
    """A ustar header with fixed owner, mode and time."""
    head = bytearray(512)
    for place, value in ((0, name.encode()[:100]), (100, b"0000644\0"), (108, b"0000000\0"), (116, b"0000000\0"), (124, b"%011o\0" % size), (136, b"00000000000\0"), (148, b" " * 8), (156, b"0"), (257, b"ustar\x0000")):
        head[place : place + len(value)] = value
    head[148:156] = b"%06o\0 " % sum(head)
    return bytes(head)


class ArchiveWriter:
    """A tar file with its sidecar."""

    def __init__(self, uri: str):
        self.uri, self.file, self.side, self.members = uri, AtomicFile(uri), AtomicFile(uri + ".idx"), 0

    def add(self, name: str, data: bytes) -> None:
        at_ = self.file.size
        self.file.write(tar_header(name, len(data)) + data + bytes(-len(data) % 512))
        self.side.write(struct.pack(ENTRY, at_, at_ + 512, len(data), zlib.crc32(data)))
        self.members += 1

    def close(self) -> tuple[str, int, int]:
        self.file.write(bytes(1024))
        self.side.close()
        self.file.close()
        return self.uri, self.members, self.file.size


def write_media(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Store texts as archives under folder; a row (archive, members, bytes) for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, number, done = None, 0, []
        for batch in by_bytes(batches):
            for doc_id, value in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (key, text)]):
                if writer is None:
                    writer = ArchiveWriter(f"{folder}/part-{TaskContext.get().partitionId():06d}-{number:04d}.tar")
                    number += 1
                raw = (value or "").encode()
                writer.add(f"{'null' if doc_id is None else doc_id}.png", encode_png(raw + bytes(-len(raw) % WIDTH or (0 if raw else WIDTH)), len(raw)))
                if writer.file.size >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["archive", "members", "bytes"])

    return need_columns(docs, key, text).mapInArrow(run, "archive string, members long, bytes long")


class ByteRange(InputPartition):
    def __init__(self, archive: str, size: int, start: int, end: int):
        self.archive, self.size, self.start, self.end = archive, size, start, end


class MediaReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.batch_bytes = int(options.get("batchbytes", BATCH_BYTES))
        self.tries = int(options.get("tries", TRIES))
        self.fail = options.get("onerror", "fail") == "fail"

    def partitions(self) -> list[ByteRange]:
        """Byte ranges over the archives of the directory."""
        fs, path = at(self.folder)
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        prefix = self.folder[: len(self.folder) - len(path)] if self.folder.endswith(path) else ""
        archives = sorted((prefix + x.path, x.size) for x in found if x.type == pafs.FileType.File and x.path.endswith(".tar"))
        return [ByteRange(uri, size, start, start + self.range_bytes) for uri, size in archives for start in range(0, size, self.range_bytes)] or [ByteRange("", 0, 0, 0)]

    def members(self, part: ByteRange) -> Iterator[tuple[int, int, int, int | None]]:
        """(header offset, data offset, data length, CRC-32) of members that start in the range."""
        fs, path = at(part.archive)
        if fs.get_file_info(path + ".idx").type == pafs.FileType.File:
            with fs.open_input_file(path + ".idx") as side:
                low, high = 0, side.size() // ENTRY_BYTES
                while low < high:
                    side.seek(((mid := (low + high) // 2)) * ENTRY_BYTES)
                    if struct.unpack(ENTRY, side.read(ENTRY_BYTES))[0] < part.start:
                        low = mid + 1
                    else:
                        high = mid
                side.seek(low * ENTRY_BYTES)
                while len(block := side.read(ENTRY_BYTES * 4096)) >= ENTRY_BYTES:
                    for entry in struct.iter_unpack(ENTRY, block):
                        if entry[0] >= part.end:
                            return
                        yield entry
        else:
            with fs.open_input_file(path) as file:
                at_ = 0
                while at_ < part.end and at_ + 512 <= part.size:
                    file.seek(at_)
                    head = file.read(512)
                    if not head.strip(b"\0"):
                        return
                    length = int(head[124:135], 8)
                    if at_ >= part.start:
                        yield at_, at_ + 512, length, None
                    at_ += 512 + length + -length % 512

    def member(self, part: ByteRange, entry: tuple, streams: list) -> tuple[str, bytes | None, str | None]:
        """Name and data of one member, sought in the range's stream; a stream that failed is closed, and the next
        try opens another. streams holds the open one, if any."""
        start, data_at, length, crc = entry
        for attempt in range(self.tries):
            try:
                if not streams:
                    fs, path = at(part.archive)
                    streams.append(fs.open_input_file(path))
                streams[0].seek(start)
                block = streams[0].read(data_at - start + length)
                data = block[data_at - start :]
                if len(data) != length or crc is not None and zlib.crc32(data) != crc:
                    raise OSError("the member does not have its checksum")
                return block[:100].rstrip(b"\0").decode(), data, None
            except OSError as error:
                problem = f"{part.archive} at {start}: {error}"
                self.close(streams)
                time.sleep(0.05 * 2**attempt)
        if self.fail:
            raise OSError(problem)
        return "", None, problem

    @staticmethod
    def close(streams: list) -> None:
        while streams:
            try:
                streams.pop().close()
            except OSError:  # it is given up anyway
                pass

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        rows, held, streams = [], 0, []
        try:
            for entry in self.members(part) if part.archive else ():
                name, data, problem = self.member(part, entry, streams)
                rows.append((part.archive, name, entry[0], data, problem))
                held += len(data or b"")
                if held >= self.batch_bytes:
                    yield self.batch(rows)
                    rows, held = [], 0
            if rows:
                yield self.batch(rows)
        finally:
            self.close(streams)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(directory)``; options rangeBytes, batchBytes,
    tries, onError (``fail``, or ``report`` to return a failed member with its error)."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options)


def read_media(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(**options).load(folder)


def describe(payload: bytes) -> str:
    """Mean, deviation, entropy and neighbour correlation of the samples, as text."""
    samples = np.frombuffer(payload, dtype=np.uint8)
    counts = np.bincount(samples, minlength=256)
    share = counts[counts > 0] / len(samples)
    wide = samples.astype(np.int64)
    steps = np.abs(np.diff(wide)).mean() if len(wide) > 1 else 0.0
    return f"mean={wide.mean():.4f};std={wide.std():.4f};entropy={-(share * np.log2(share)).sum():.4f};step={steps:.4f};values={len(share)}"


def media_features(media: DataFrame) -> DataFrame:
    """Decode members and compute their features; member names carry the doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            rows = []
            for name, stored in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("member", "media")]):
                payload, n_bytes = decode_png(stored)
                key = name.rpartition("/")[2].removesuffix(".png")
                rows.append((None if key == "null" else int(key), n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), describe(payload)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), FEATURES)], schema=FEATURES)

    ddl = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in FEATURES)
    return media.select("member", "media").mapInArrow(run, ddl)


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_path(spark, "media")
    materialise(write_media(docs, folder), "media-written").count()
    return media_features(read_media(spark, folder))
