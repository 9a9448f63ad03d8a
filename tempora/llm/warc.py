"""WARC archives: a writer, a normaliser of monolithic gzip files, and a reader by offset.

The writer turns rows into WARC records, one archive for each Spark partition, compressed as a
single gzip stream over the whole file. Such a file can only be read from its start. The
normaliser inflates the stream once, rewrites every record as a gzip member of its own, and writes
a sidecar index of the members' offsets. After that any record is read on its own, so reading
splits by ranges of the index.

Archives lie in the shared folder. Tasks write under a staging name and move the whole file into
place: a task that runs again replaces the file by an equal one.

Defined cases: null html is an empty payload; a null page_id leaves its header out and reads back
as null; it is never the one referred to unless all of its group are null, which are then all
responses. Rows that share page_id and payload are all responses if theirs is the largest page_id.
An empty table gives no archive and no rows. Control characters in a URL are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, delete_path, materialise, need_columns, new_path, partitions_for
from .files import AtomicFile, at

#: Payloads of fewer bytes are always stored.
MIN_REVISIT_BYTES = 1000
#: Groups of equal payloads up to this number are broadcast (some 80 bytes each).
BROADCAST_GROUPS = 100_000
LEVEL = 4
CHUNK = 1 << 18
#: Archive bytes that one read task takes.
RANGE_BYTES = 8 << 20
WHEN = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WRITTEN = pa.schema([("archive", pa.string()), ("records", pa.int64())])
INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string())])
READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def safe_url(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "urn:none")


def record_header(kind: str, record_id: str, length: int, content_type: str, **more: str) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {WHEN}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items()]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def page_urn(page_id) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def page_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """A response record, or a revisit of another page's where refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    more = {"WARC_Target_URI": safe_url(url), "WARC_Payload_Digest": "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()}
    if page_id is not None:
        more["Page_Id"] = str(page_id)
    if refers_to is None:
        block, kind = http + payload, "response"
    else:
        block, kind = http, "revisit"
        more |= {"WARC_Refers_To": f"<{page_urn(refers_to)}>", "WARC_Profile": PROFILE}
    return record_header(kind, page_urn(page_id), len(block), "application/http; msgtype=response", **more) + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write page_id, url, html, refers_to as records; a row (archive, records) for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, squeeze, records = None, None, 0
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        for batch in by_bytes(batches):
            for page_id, url, html, refers_to in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("page_id", "url", "html", "refers_to")]):
                if file is None:
                    file, squeeze = AtomicFile(name), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    note = b"software: tempora\r\nformat: WARC File Format 1.1\r\n"
                    file.write(squeeze.compress(record_header("warcinfo", f"urn:archive:{TaskContext.get().partitionId()}", len(note), "application/warc-fields") + note + b"\r\n\r\n"))
                file.write(squeeze.compress(page_record(page_id, url, (html or "").encode(), refers_to)))
                records += 1
        if file is not None:
            file.write(squeeze.flush())
            file.close()
            yield batch_of([(name, records)], WRITTEN)

    return pages.mapInArrow(run, ddl(WRITTEN))


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in bounded pieces, read once."""
    inflate = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            if piece := inflate.decompress(data, CHUNK):
                yield piece
            if inflate.eof:
                data = inflate.unused_data
                inflate = zlib.decompressobj(31)
            else:
                data = inflate.unconsumed_tail
    if piece := inflate.flush():
        yield piece


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def normalise(archive: str, target: str) -> Iterator[tuple]:
    """Rewrite an archive with one gzip member for each record; index rows in file order. Neither
    the file nor a record is held whole."""
    fs, path = at(archive)
    out, side = AtomicFile(target), AtomicFile(target + ".idx")
    with fs.open_input_stream(path, compression=None) as stream:
        pieces, held = inflated(stream), b""
        while True:
            while (end := held.find(b"\r\n\r\n")) < 0:
                more = next(pieces, None)
                if more is None:
                    break
                held += more
            if end < 0:
                if held.strip():
                    raise ValueError(f"{archive} ends inside a record")
                break
            fields = parse_header(held[:end])
            left = end + 4 + int(fields["content-length"]) + 4
            offset, squeeze = out.size, zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            while left:
                if not held:
                    held = next(pieces, b"")
                    if not held:
                        raise ValueError(f"{archive} ends inside a record")
                part, held = held[:left], held[left:]
                left -= len(part)
                out.write(squeeze.compress(part))
            out.write(squeeze.flush())
            row = (target, offset, out.size - offset, fields["warc-type"], fields.get("warc-record-id", "").strip("<>"))
            side.write(("\t".join(map(str, row[1:])) + "\n").encode())
            yield row
    out.close()
    side.close()


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Index rows of the archives (column ``archive``) rewritten into folder, each with its
    sidecar file ``.idx``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(batch.schema.get_field_index("archive")).to_pylist():
                rows = []
                for row in normalise(archive, f"{folder}/{archive.rpartition('/')[2]}"):
                    rows.append(row)
                    if len(rows) >= 8192:
                        yield batch_of(rows, INDEX)
                        rows = []
                if rows:
                    yield batch_of(rows, INDEX)

    return archives.mapInArrow(run, ddl(INDEX))


def read_record(data: bytes) -> tuple[dict, dict, bytes]:
    """WARC fields, HTTP fields and payload of one member."""
    raw = zlib.decompress(data, 31)
    end = raw.index(b"\r\n\r\n")
    fields = parse_header(raw[:end])
    block = raw[end + 4 : end + 4 + int(fields["content-length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    return fields, parse_header(head), payload


def read_archives(index: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Read page records back by the offsets of the index; response payloads are digested anew
    and held against their header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, stream = None, None
        for batch in by_bytes(batches):
            rows = []
            for archive, offset, length in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("archive", "offset", "length")]):
                if archive != name:
                    if stream:
                        stream.close()
                    fs, path = at(archive)
                    name, stream = archive, fs.open_input_file(path)
                stream.seek(offset)
                fields, http, payload = read_record(stream.read(length))
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                kind, refers_to = fields["warc-type"], None
                if kind == "response":
                    found, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    if found != digest:
                        raise ValueError(f"{archive} at {offset}: the payload does not have its digest")
                else:
                    size, refers_to = int(http["content-length"]), int(fields["warc-refers-to"].strip("<>").rpartition(":")[2])
                page = fields.get("page-id")
                rows.append((None if page is None else int(page), size, digest, kind, refers_to))
            if rows:
                yield batch_of(rows, READ)
        if stream:
            stream.close()

    pages = index.where("record_type in ('response', 'revisit')").withColumn("_range", F.floor(F.col("offset") / range_bytes))
    dealt = pages.repartition(partitions_for(index.sparkSession), "archive", "_range").sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(run, ddl(READ))


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """pages with refers_to: the largest page_id of the records with an equal payload, where that
    is another record and the payload has at least min_bytes. Payloads are not shuffled as long
    as the groups of equal ones are few enough to be broadcast."""
    keyed = pages.withColumns({"_bytes": F.octet_length(F.coalesce("html", F.lit(""))), "_digest": F.sha1(F.coalesce("html", F.lit("")).cast("binary"))})
    groups = keyed.where(F.col("_bytes") >= min_bytes).groupBy("_digest", "_bytes").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1 and _last is not null")
    groups = materialise(groups.select(F.col("_digest").alias("_of"), F.col("_bytes").alias("_of_bytes"), "_last"), "warc-groups")
    if groups.count() <= broadcast_groups:
        groups = F.broadcast(groups)
    joined = keyed.join(groups, (F.col("_digest") == F.col("_of")) & (F.col("_bytes") == F.col("_of_bytes")), "left")
    return joined.select(*pages.columns, F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("_last")), F.col("_last")).alias("refers_to"))


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) as archives under folder; the index of their records."""
    spark = pages.sparkSession
    written = materialise(write_archives(mark_revisits(pages), f"{folder}/monolithic"), "warc-written")
    n = max(1, min(written.count(), 4 * partitions_for(spark)))
    index = materialise(normalise_archives(written.repartition(n), f"{folder}/archives"), "warc-index")
    delete_path(spark, f"{folder}/monolithic")
    return index


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = need_columns(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html")
    return read_archives(archive_pages(pages, new_path(spark, "warc")))


OP4_SQL = """
WITH keyed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), marked AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM keyed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN last IS NOT NULL AND last IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM marked
"""
