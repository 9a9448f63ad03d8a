"""Vector bin packing of token pieces into sequences.

Each document becomes token ids plus an end id. Whole sequences' worth of ids are cut off and
stand alone; the rest is an item with a vector of demands (tokens, segments, loss-bearing tokens).
Items are placed by the dot-product heuristic: of the items that fit an open bin, the one whose
demands, each relative to its limit, have the largest dot product with what is left of the bin.
Every item of the pool is a candidate at each step. Where none fits and enough room is left, the
shortest of the longer items is cut to fill it.

Packing is done within a Spark partition over a pool of bounded size, in one pass over the scan:
no shuffle, nothing gathered. At the end of a partition at most one sequence stays part-filled,
which is cut into power-of-two lengths, as such sequences need no padding.

Defined cases: null text is empty; an empty document is its end id alone. Repeated rows and equal
doc_ids are packed one by one. A long text is tokenized in stretches cut before a single blank
between two other characters, where every pre-token ends.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import by_bytes, need_columns

SEQUENCE_TOKENS = 1024
#: Limits of a sequence besides its tokens: segments, and loss-bearing tokens.
MAX_SEGMENTS, MAX_LOSS = 64, 1024
END_ID = 0
#: Items held while packing in one task, and the smallest piece an item is cut to.
POOL, MIN_CUT = 2048, 8
#: Texts are tokenized in stretches of about this many characters.
STRETCH = 65_536

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Token ids of whole texts, by a byte-level BPE file of the tokenizers library.

    Where the file's merges are in the order of its ids, Latin text is encoded by tiktoken over the
    file's own vocabulary, which gives the same ids several times faster. Texts with characters
    beyond the Latin blocks take the tokenizers library, so that its Unicode tables decide, and so do
    texts that hold one of the file's added tokens, which that library gives an id of its own.
    """

    #: The pre-token pattern of this kind of file. Fixed value.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    BEYOND_LATIN = re.compile("[^\x00-\u024f]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self.ranked(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = re.compile("|".join(re.escape(t.content) for t in added)) if added else None
        #: Added tokens that may not be parted at a blank.
        self.blanks = any(t.lstrip or t.rstrip or any(c.isspace() for c in t.content) for t in added)

    def ranked(self, path: str):
        """A tiktoken encoding of the file's vocabulary; None where the file is of another kind."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        if model["type"] != "BPE" or not plain:
            return None
        shown = {i for i in range(256) if 33 <= i <= 126 or 161 <= i <= 172 or 174 <= i <= 255}
        hidden = [i for i in range(256) if i not in shown]
        byte_of = {chr(i): i for i in shown} | {chr(256 + k): i for k, i in enumerate(hidden)}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        vocab, ordered = model["vocab"], -1
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if vocab[left + right] <= ordered:
                return None
            ordered = vocab[left + right]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        return tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def stretch(self, text: str) -> np.ndarray:
        if self.fast and (text.isascii() or not self.BEYOND_LATIN.search(text)) and not (self.added and self.added.search(text)):
            return np.array(self.fast(text), dtype=np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        if len(text) <= STRETCH or self.blanks and self.added.search(text):
            return self.stretch(text)
        out, at = [], 0
        while at < len(text):
            end = min(len(text), at + STRETCH)
            while end < len(text) and not (text[end] == " " and not text[end - 1].isspace() and end + 1 < len(text) and not text[end + 1].isspace()):
                end += 1
            out.append(self.stretch(text[at:end]))
            at = end
        return np.concatenate(out)


class Packer:
    """Places items (key, start, length) into bins of the given limits; yields closed bins as
    lists of (key, start, length, offset). The leading tokens of an item may bear no loss."""

    def __init__(self, tokens: int, segments: int, loss: int, pool: int = POOL, min_cut: int = MIN_CUT):
        self.limits, self.pool, self.min_cut = (tokens, segments, loss), pool, min_cut
        self.items: list[tuple] = []  # key, start
        self.length, self.loss = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    @property
    def held(self) -> int:
        return len(self.items)

    def add(self, key, start: int, length: int, loss: int) -> None:
        n = len(self.items)
        if n == len(self.length):
            self.length, self.loss = (np.concatenate([x, np.zeros(n + 64, dtype=np.int64)]) for x in (self.length, self.loss))
        self.items.append((key, start))
        self.length[n], self.loss[n] = length, loss

    def take(self, i: int) -> tuple:
        """Item i, out of the pool; the last item moves to its place."""
        key, start = self.items[i]
        length, loss = int(self.length[i]), int(self.loss[i])
        last = self.items.pop()
        if i < len(self.items):
            self.items[i], self.length[i], self.loss[i] = last, self.length[len(self.items)], self.loss[len(self.items)]
        return key, start, length, loss

    def best(self, left: tuple[int, int, int]) -> int:
        """Of all items that fit, the one whose relative demands have the largest dot product with
        what is left of the limits, the first of equals; -1 if none fits."""
        n = len(self.items)
        length, loss = self.length[:n], self.loss[:n]
        (cap_t, cap_s, cap_l), (t, s, l) = self.limits, left
        dot = np.where((length <= t) & (loss <= l), length * (t / cap_t**2) + loss * (l / cap_l**2) + s / cap_s**2, -1.0)
        i = int(dot.argmax())
        return i if dot[i] >= 0 else -1

    def cut(self, left: tuple[int, int, int]) -> tuple | None:
        """The first piece, as large as fits, of the shortest item that can fill what is left."""
        n = len(self.items)
        length, loss = self.length[:n], self.loss[:n]
        room = np.minimum(left[0], length - loss + left[2])
        wide = np.where((room >= self.min_cut) & (length > room), length, np.iinfo(np.int64).max)
        i = int(wide.argmin())
        if wide[i] == np.iinfo(np.int64).max:
            return None
        size = int(room[i])
        key, start, length, loss = self.take(i)
        bears = max(0, size - (length - loss))
        self.add(key, start + size, length - size, loss - bears)
        return key, start, size, bears

    def pack(self, until: int) -> Iterator[list[tuple]]:
        """Closes bins as long as more than ``until`` items are held."""
        while self.held > until:
            bin_, used = [], 0
            left = self.limits
            while left[0] > 0 and left[1] > 0 and self.held:
                i = self.best(left)
                item = self.take(i) if i >= 0 else self.cut(left)
                if item is None:
                    break
                key, start, length, loss = item
                bin_.append((key, start, length, used))
                used += length
                left = (left[0] - length, left[1] - 1, left[2] - loss)
            yield bin_


def powers(bin_: list[tuple], least: int) -> Iterator[list[tuple]]:
    """A part-filled bin cut into bins of power-of-two lengths, down to ``least`` tokens."""
    rest = sum(p[2] for p in bin_)
    while bin_:
        size = 1 << (rest.bit_length() - 1)
        if size < least:
            size = rest
        out, room = [], size
        while room:
            key, start, length, _ = bin_.pop(0)
            took = min(room, length)
            out.append((key, start, took, size - room))
            room -= took
            if took < length:
                bin_.insert(0, (key, start + took, length - took, 0))
        rest -= size
        yield out


def pack_documents(docs: DataFrame, tokenizer: str, keys: list[str], text: str = "text", tokens: int = SEQUENCE_TOKENS, segments: int = MAX_SEGMENTS, loss: int = MAX_LOSS, end_id: int | None = END_ID, masked: str | None = None) -> DataFrame:
    """One row for each piece: the key columns, then start, length, ids_crc32, doc_tokens,
    sequence_id and offset. ``masked`` names a column of leading tokens that bear no loss."""
    cols = list(dict.fromkeys([*keys, text, *([masked] if masked else [])]))
    docs = need_columns(docs, *cols)
    key_fields = [f for f in docs.schema.fields if f.name in keys]
    schema = pa.schema([*[(f.name, _arrow_type(f)) for f in key_fields], *[(n.split()[0], pa.int64()) for n in PIECES.split(", ")]])
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields], PIECES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        packer = Packer(tokens, segments, loss)
        base = TaskContext.get().partitionId() << 40
        numbers = iter(range(1 << 40))
        pending: dict[int, tuple] = {}  # documents with items in the pool: what is not packed yet of their ids
        count = 0
        rows: list[list] = []

        def put(bins):
            for bin_ in bins:
                sequence = base + next(numbers)
                for key, start, length, offset in bin_:
                    values, tail, skipped, total, open_tokens = pending[key]
                    piece = tail[start - skipped : start - skipped + length]
                    rows.append([*values, start, length, zlib.crc32(piece.astype("<u4").tobytes()), total, sequence, offset])
                    if open_tokens == length:
                        del pending[key]
                    else:
                        pending[key] = (values, tail, skipped, total, open_tokens - length)

        def out():
            nonlocal rows
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
            return batch

        for batch in by_bytes(batches):
            columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            skip = batch.column(batch.schema.get_field_index(masked)).to_pylist() if masked else None
            for i, value in enumerate(texts):
                ids = encode(value or "")
                if end_id is not None:
                    ids = np.append(ids, np.uint32(end_id))
                if not len(ids):
                    continue
                values = tuple(c[i] for c in columns)
                pending[count] = (values, ids, 0, len(ids), len(ids))
                free = min(len(ids), (skip[i] or 0) if skip else 0)
                start = 0
                while len(ids) - start >= (whole := min(tokens, max(0, free - start) + loss)):
                    put([[(count, start, whole, 0)]])
                    start += whole
                if start < len(ids):
                    if start:  # the pool holds the tail alone, however long the text
                        pending[count] = (values, ids[start:].copy(), start, len(ids), len(ids) - start)
                    packer.add(count, start, len(ids) - start, max(0, len(ids) - max(start, free)))
                count += 1
                if packer.held > packer.pool:
                    put(packer.pack(packer.pool // 2))
                if len(rows) >= 8192:
                    yield out()
        held = None
        for bin_ in packer.pack(0):
            if held:
                put([held])
            held = bin_
        if held:
            size = sum(p[2] for p in held)
            put([held] if size == tokens else powers(held, 16))
        if rows:
            yield out()

    return docs.mapInArrow(run, ddl)


def _arrow_type(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def op6_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, tokenizer or default_tokenizer(), ["doc_id"])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
