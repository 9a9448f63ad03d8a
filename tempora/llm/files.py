"""Byte files in the shared folder, by URI, from inside tasks."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def at(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI or absolute path (file, hdfs, s3, gs)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file written under a name of its own and moved into place at the end, so that a task
    that runs twice leaves one whole file."""

    def __init__(self, uri: str):
        self.fs, self.path = at(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.staged = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.stream = self.fs.open_output_stream(self.staged)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.staged, self.path)

    def abandon(self) -> None:
        self.stream.close()
        self.fs.delete_file(self.staged)
