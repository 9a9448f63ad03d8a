"""Standard MIDI files: reading note rows, and writing them.

Files come through Spark's binary reader, so any store that Spark reads will do, and each file is parsed in the task that
read it. A file that is damaged gives one row with what is wrong, and no note; the others are read all the same. Spark passes over
files of no bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import entity_of

#: Microseconds of a quarter note where a file sets no tempo. Fixed value.
TEMPO = 500_000
NOTES = pa.schema([("track", pa.int32()), ("channel", pa.int32()), ("program", pa.int32()), ("pitch", pa.int32()), ("velocity", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("error", pa.string())])


class DamagedMidi(ValueError):
    """What is wrong with a file, and where."""


@dataclass
class Note:
    track: int
    channel: int
    program: int
    pitch: int
    velocity: int
    start: int
    end: int


class Events:
    """The events of one track chunk: (tick, status, data), meta events as status 0xFF with their type first."""

    def __init__(self, data: bytes, number: int):
        self.data, self.number, self.at = data, number, 0

    def damaged(self, what: str) -> DamagedMidi:
        return DamagedMidi(f"track {self.number}, byte {self.at}: {what}")

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise self.damaged("the track ends within an event")
        self.at += n
        return self.data[self.at - n : self.at]

    def length(self) -> int:
        """A number in groups of seven bits, the last without the high bit; four bytes at most."""
        value = 0
        for _ in range(4):
            (byte,) = self.take(1)
            value = value << 7 | byte & 0x7F
            if byte < 0x80:
                return value
        raise self.damaged("a length of more than four bytes")

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        tick, running = 0, 0
        while self.at < len(self.data):
            tick += self.length()
            (status,) = self.take(1)
            if status < 0x80:  # running status: this byte is data of the last channel message's kind
                if not running:
                    raise self.damaged("data without a status")
                self.at -= 1
                status = running
            if status == 0xFF:
                kind = self.take(1)
                data = self.take(self.length())
                yield tick, status, kind + data
                if kind[0] == 0x2F:
                    return
            elif status in (0xF0, 0xF7):
                self.take(self.length())
                running = 0
            elif status >= 0xF0:
                raise self.damaged(f"status {status:#x} does not stand in files")
            else:
                running = status
                data = self.take(1 if status & 0xF0 in (0xC0, 0xD0) else 2)
                if any(b >= 0x80 for b in data):
                    raise self.damaged("a data byte with its high bit set")
                yield tick, status, data


def chunks(data: bytes) -> tuple[int, list[bytes]]:
    """The division and the track chunks of a file; chunks of other kinds are passed over."""
    if data[:4] != b"MThd" or len(data) < 14:
        raise DamagedMidi("byte 0: no header")
    (size,) = struct.unpack_from(">I", data, 4)
    _, count, division = struct.unpack_from(">HHH", data, 8)
    if size < 6 or not division:
        raise DamagedMidi("byte 4: a header of no use")
    at, tracks = 8 + size, []
    while len(tracks) < count:
        if at + 8 > len(data):
            raise DamagedMidi(f"byte {at}: {count - len(tracks)} of {count} tracks are missing")
        kind, (length,) = data[at : at + 4], struct.unpack_from(">I", data, at + 4)
        if at + 8 + length > len(data):
            raise DamagedMidi(f"byte {at}: the file ends within a chunk")
        if kind == b"MTrk":
            tracks.append(data[at + 8 : at + 8 + length])
        at += 8 + length
    return division, tracks


class Clock:
    """Seconds of ticks under a tempo map; tempos of all tracks hold for all of them."""

    def __init__(self, division: int, tempos: dict[int, int]):
        self.fixed = None
        if division & 0x8000:  # frames a second and ticks a frame
            self.fixed = 1.0 / ((256 - (division >> 8)) * (division & 0xFF))
        self.starts, seconds, last, tempo = [], 0.0, 0, TEMPO
        for tick, new in sorted(tempos.items()):
            seconds += (tick - last) * tempo / (1e6 * division)
            self.starts.append((tick, seconds, new / (1e6 * division)))
            last, tempo = tick, new
        if not self.starts or self.starts[0][0] > 0:
            self.starts.insert(0, (0, 0.0, TEMPO / (1e6 * division)))

    def seconds(self, tick: int) -> float:
        if self.fixed is not None:
            return tick * self.fixed
        low, high = 0, len(self.starts)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.starts[middle][0] <= tick else (low, middle)
        start, seconds, unit = self.starts[low]
        return seconds + (tick - start) * unit


def parse_midi(data: bytes) -> tuple[Clock, list[Note]]:
    """The clock and the notes of a file. A note ends at the next note-off (or note-on of velocity 0) of its track, channel and
    pitch behind its start, which ends all that are open; those never ended are left out."""
    division, tracks = chunks(data)
    tempos, notes = {}, []
    for number, track in enumerate(tracks):
        open_: dict[tuple[int, int], list[Note]] = {}
        program = [0] * 16
        for tick, status, data_ in Events(track, number):
            channel, kind = status & 0x0F, status & 0xF0
            if status == 0xFF:
                if data_[0] == 0x51:
                    if len(data_) != 4:
                        raise DamagedMidi(f"track {number}: a tempo of {len(data_) - 1} bytes")
                    tempos[tick] = int.from_bytes(data_[1:], "big")
            elif kind == 0xC0:
                program[channel] = data_[0]
            elif kind == 0x90 and data_[1]:
                open_.setdefault((channel, data_[0]), []).append(Note(number, channel, program[channel], data_[0], data_[1], tick, tick))
            elif kind in (0x80, 0x90):
                held = open_.get((channel, data_[0]), [])
                for note in held:
                    if note.start < tick:
                        note.end = tick
                        notes.append(note)
                open_[channel, data_[0]] = [note for note in held if note.start == tick]
    return Clock(division, tempos), notes


def midi_notes(files: DataFrame, content: str = "content") -> DataFrame:
    """The columns of files but the content, and for each note track, channel, program, pitch, velocity, start_s and end_s to
    six digits, in order of start, pitch and end within a file; for a damaged file one row with ``error``."""
    keep = [f for f in files.schema.fields if f.name != content]
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keep], "track int, channel int, program int, pitch int, velocity int, start_s double, end_s double, error string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                try:
                    clock, notes = parse_midi(batch.column(len(keep))[i].as_py() or b"")
                    rows = [(n.track, n.channel, n.program, n.pitch, n.velocity, round(clock.seconds(n.start), 6), round(clock.seconds(n.end), 6), None) for n in notes]
                    rows.sort(key=lambda r: (r[5], r[3], r[6]))
                except DamagedMidi as error:
                    rows = [(*[None] * 7, str(error))]
                for at in range(0, len(rows), 10_000):
                    some = rows[at : at + 10_000]
                    own = pa.array([i] * len(some), pa.int64())
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).take(own) for c in range(len(keep))], *[pa.array(c, f.type) for c, f in zip(zip(*some), NOTES)]], names=[*[f.name for f in keep], *NOTES.names])

    return files.select(*[F.col(f"`{f.name}`") for f in keep], F.col(f"`{content}`")).mapInArrow(run, ddl)


def read_midi(spark: SparkSession, path: str) -> DataFrame:
    """Notes of all files of the suffixes mid and midi under a path, with path and entity_id, the file's stem."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return midi_notes(found.where(F.lower("path").rlike(r"\.midi?$")).withColumn("entity_id", entity_of(F.col("path"))))


def number_bytes(value: int) -> bytes:
    out = bytes([value & 0x7F])
    while value := value >> 7:
        out = bytes([value & 0x7F | 0x80]) + out
    return out


def encode_midi(notes: list[tuple[int, int, int, int, int]], division: int = 480, tempos: list[tuple[int, int]] = ()) -> bytes:
    """A file of one track: notes (start tick, end tick, channel, pitch, velocity) and tempos (tick, microseconds of a quarter)."""
    events = [(tick, 0, b"\xff\x51\x03" + tempo.to_bytes(3, "big")) for tick, tempo in tempos]
    events += [(end, 1, bytes([0x80 | channel, pitch, 0])) for _, end, channel, pitch, _ in notes] + [(start, 2, bytes([0x90 | channel, pitch, velocity])) for start, _, channel, pitch, velocity in notes]
    out, last = b"", 0
    for tick, _, data in sorted(events):
        out += number_bytes(tick - last) + data
        last = tick
    out += b"\x00\xff\x2f\x00"
    return b"MThd" + struct.pack(">IHHH", 6, 0, 1, division) + b"MTrk" + struct.pack(">I", len(out)) + out


def as_midi(notes: DataFrame, division: int = 480, tempos: list[tuple[int, int]] = ()) -> DataFrame:
    """(entity_id, content): a MIDI file for each entity of notes (entity_id, start_tick, end_tick, channel, pitch, velocity). A file is one
    row, so an entity is one song."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = [encode_midi([tuple(n.values()) for n in one], division, tempos) for one in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], names=["entity_id", "content"])

    whole = notes.groupBy("entity_id").agg(F.collect_list(F.struct("start_tick", "end_tick", "channel", "pitch", "velocity")).alias("notes"))
    return whole.mapInArrow(run, f"entity_id {whole.schema['entity_id'].dataType.simpleString()}, content binary")
