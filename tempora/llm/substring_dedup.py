"""Removal of repeated byte strings, found with suffix arrays.

A byte goes if it lies in a string of ``span`` bytes that also starts anywhere else, in the same
document or another. Texts are judged as they come in, so the order of removals does not matter.

1. Equal texts are one text with a count; one that is repeated and long enough goes as a whole.
2. Every window of ``span`` bytes is assigned to the anchor in it: the n-gram of least hash, the
   rightmost of equals. Equal windows have equal anchors at equal places. Anchors that occur at
   one place only are dropped, by a group-by on (anchor hash, least place, largest place).
3. The bytes of the windows of each remaining anchor, its context, go to the anchor's group, equal
   contexts once with a count, by a 128-bit digest. A context that occurs twice is repeated throughout.
4. In a group with several contexts, each is written as a string of block symbols, blocks being
   aligned at the anchor. Their suffix array brings together all suffixes that share a window's
   whole blocks; among those, the bytes at both ends are compared for each alignment.
5. A group of more contexts than one task should hold is dealt out anew by a longer key: a window holds the
   anchor and also half of what is left of its bytes either just before the anchor or just after it, so each context
   goes, cut to those windows, to the group of the anchor with the bytes before it and to that with the bytes after
   it. Equal windows meet in one of them. This is done again with the longer key until every group fits; when the
   key is a window's length, a group is one window.
6. The spans found are gathered for each text, merged and cut out.

Texts are shuffled twice, by their digest; all else is narrow. Contexts are about one and a half
times the bytes of the candidate windows. No group, hot or not, is gathered beyond ``MAX_CONTEXTS``
distinct contexts.

Defined cases: null text is empty; texts shorter than a span lose nothing; repeated rows are
repeats of each other, like any equal texts. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, forget, materialise, need_columns, partitions_for
from .suffix_array import suffix_array

SPAN = 400
#: Passages of more than about fifty short words: their least bytes, and those of an anchor in them.
PASSAGE_BYTES, PASSAGE_GRAM = 240, 64
#: Bytes of an anchor, of a block symbol, and of the stretch of a text that is hashed at once.
GRAM, BLOCK, STRETCH = 96, 16, 1 << 17
#: Distinct contexts of one anchor that are put in one suffix array.
MAX_CONTEXTS = 4000
#: Contexts whose bytes a task remembers having sent.
REMEMBERED = 500_000
NO_BYTES = hashlib.sha256(b"").hexdigest()


class Grams:
    """Rolling hashes of a text's n-grams, 64 bits, by a polynomial over random byte values."""

    def __init__(self, seed: int = 1, size: int = STRETCH + 1024):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64)
        base = int(rng.integers(1, 2**62)) * 2 + 1
        self.up, self.down = self.powers(base, size), self.powers(pow(base, -1, 2**64), size)

    @staticmethod
    def powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def __call__(self, data: np.ndarray, n: int) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        h = (sums[n:] - sums[:-n]) * self.down[: len(data) - n + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def window_anchors(data: np.ndarray, grams: Grams, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of a stretch of at least span bytes: hash and place of each anchor, and the first and the
    last start of the windows that are assigned to it."""
    width = span - gram + 1
    h = grams(data, gram)
    bits = np.uint64((1 << 20) - 1)
    ranked = (h & ~bits) | (bits - np.arange(len(h), dtype=np.uint64))  # equal hashes: the rightmost is least
    padded = np.concatenate([ranked, np.full(-len(h) % width, 2**64 - 1, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(h) - width + 1
    places = (bits - (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(places)) + 1
    first = np.concatenate([[0], cuts])
    last = np.concatenate([cuts, [windows]]) - 1
    at = places[first]
    return h[at], at, first, last


def stretches(data: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping pieces of a long text, so that each window lies in exactly one."""
    for at in range(0, max(1, len(data) - span + 1), STRETCH):
        yield at, data[at : at + STRETCH + span - 1]


def anchor_rows(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(anchor, key, place, first, last) of texts (key, text) of at least span bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in by_bytes(batches):
            out, keys, rows = [], batch.column(0), []
            for i, value in enumerate(batch.column(1).to_pylist()):
                data = np.frombuffer((value or "").encode(), dtype=np.uint8)
                if len(data) < span:
                    continue
                for at, piece in stretches(data, span):
                    h, place, first, last = window_anchors(piece, grams, span, gram)
                    out.append((h, place + at, first + at, last + at))
                    rows.append(np.full(len(h), i))
            if out:
                h, place, first, last = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), keys.take(pa.array(np.concatenate(rows))), *(pa.array(x.astype(np.int32)) for x in (place, first, last))], names=["anchor", "key", "place", "first", "last"]
                )

    return texts.select("key", "text").mapInArrow(run, "anchor long, key binary, place int, first int, last int")


def context_digest(data: bytes, lead: int) -> bytes:
    """What a context is known by: 128 bits of its bytes and of where its blocks begin."""
    return hashlib.blake2b(data, digest_size=16, salt=bytes([lead % BLOCK])).digest()


#: Contexts: the key of their group, their digest, and the text and place they come from; lead bytes stand before the anchor.
CONTEXTS = pa.schema([("anchor", pa.int64()), ("context", pa.binary()), ("key", pa.binary()), ("first", pa.int32()), ("length", pa.int32()), ("lead", pa.int32()), ("bytes", pa.binary())])


def context_rows(texts: DataFrame, span: int) -> DataFrame:
    """Contexts of texts (key, text, anchors), anchors being structs (anchor, place, first, last); bytes only
    where the task has not just sent them for the same anchor and context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, bytes]] = set()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTEXTS)], schema=CONTEXTS)

        for batch in by_bytes(batches):
            rows, held = [], 0
            for key, text, anchors in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                for a in anchors:
                    piece = data[a["first"] : a["last"] + span]
                    lead = a["place"] - a["first"]
                    mark = context_digest(piece, lead)
                    if new := (a["anchor"], mark) not in sent:
                        if len(sent) >= REMEMBERED:
                            sent.clear()
                        sent.add((a["anchor"], mark))
                        held += len(piece)
                    rows.append((a["anchor"], mark, key, a["first"], len(piece), lead, piece if new else None))
                if held > 1 << 22:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    return texts.select("key", "text", "anchors").mapInArrow(run, "anchor long, context binary, key binary, first int, length int, lead int, bytes binary")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order; those that touch are joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def repeated_windows(contexts: list[tuple[bytes, int, int]], span: int) -> list[list[tuple[int, int]]]:
    """For each context (bytes, shift, count), spans of its bytes that windows occurring at least
    twice among the contexts cover, by a suffix array over block symbols."""
    numbers: dict[bytes, int] = {}
    pieces, text, owner = [], [], []
    for c, (data, shift, _) in enumerate(contexts):
        blocks = [data[i : i + BLOCK] for i in range(shift, len(data) - BLOCK + 1, BLOCK)]
        pieces.append(blocks)
        for k in range(len(blocks)):
            owner.append((c, k))
        owner.append((c, -1))
        text += blocks
        text.append(b"")
    for n, block in enumerate(sorted(set(text)), start=1):
        numbers[block] = n
    symbols = [numbers[b] for b in text] + [0]
    whole = span // BLOCK - 1  # blocks that every window has whole, whatever its alignment
    order = suffix_array(symbols)
    starts = [set() for _ in contexts]

    def settle(run: list[int]) -> None:
        if len(run) == 1 and contexts[owner[run[0]][0]][2] < 2:
            return
        if len(run) == 2 and all(contexts[owner[i][0]][2] < 2 for i in run):  # two share an alignment if they share as many bytes at both ends
            (c, one, at), (d, two, to) = ((owner[i][0], contexts[owner[i][0]][0], contexts[owner[i][0]][1] + BLOCK * owner[i][1]) for i in run)
            before = after = 0
            while before < min(BLOCK - 1, at, to) and one[at - before - 1] == two[to - before - 1]:
                before += 1
            at_end, to_end, ends = at + BLOCK * whole, to + BLOCK * whole, span - BLOCK * whole
            most = min(ends, len(one) - at_end, len(two) - to_end)
            while after < most and one[at_end + after] == two[to_end + after]:
                after += 1
            for back in range(max(0, ends - after), before + 1):
                starts[c].add(at - back)
                starts[d].add(to - back)
            return
        for back in range(BLOCK):
            seen: dict[tuple[bytes, bytes], list] = {}
            for i in run:
                c, k = owner[i]
                data, shift, _ = contexts[c]
                at = shift + BLOCK * k
                if at - back >= 0 and at - back + span <= len(data):
                    seen.setdefault((data[at - back : at], data[at + BLOCK * whole : at - back + span]), []).append((c, at - back))
            for found in seen.values():
                if len(found) > 1 or contexts[found[0][0]][2] > 1:
                    for c, at in found:
                        starts[c].add(at)

    run: list[int] = []
    shared: list[int] = []
    for i in order:
        if i >= len(owner) or owner[i][1] < 0 or owner[i][1] + whole > len(pieces[owner[i][0]]):
            continue
        here = symbols[i : i + whole]
        if run and here != shared:
            settle(run)
            run = []
        if not run:
            shared = here
        run.append(i)
    if run:
        settle(run)
    return [merged([(s, s + span) for s in found]) for found in starts]


def cover_groups(contexts: DataFrame, span: int) -> DataFrame:
    """(anchor, context, start, end): spans repeated in each context; contexts (anchor, context,
    lead, count, bytes) are dealt out by anchor."""
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marks, anchor = [], [], None

        def close() -> list[tuple]:
            if len(held) == 1:
                data, _, count = held[0]
                return [(anchor, marks[0], 0, len(data))] if count > 1 else []
            return [(anchor, marks[c], start, end) for c, spans in enumerate(repeated_windows(held, span)) for start, end in ([(0, len(held[c][0]))] if held[c][2] > 1 else spans)]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["anchor", "context", "start", "end"])

        for batch in by_bytes(batches):
            rows = []
            for own, mark, lead, count, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if own != anchor:
                    if held:
                        rows += close()
                    held, marks, anchor = [], [], own
                held.append((data, lead % BLOCK, count))
                marks.append(mark)
            if rows:
                yield out(rows)
        if held and (rows := close()):
            yield out(rows)

    dealt = contexts.select("anchor", "context", "lead", "count", "bytes").repartition(partitions_for(contexts.sparkSession), "anchor").sortWithinPartitions("anchor", "context")
    return dealt.mapInArrow(run, "anchor long, context binary, start int, end int")


def halves(data: bytes, lead: int, core: int, span: int) -> Iterator[tuple[int, bytes, int, int]]:
    """A context's windows that hold ``core`` bytes from ``lead`` on, in two parts: (offset, bytes, lead, core) of the windows that
    hold half of their other bytes before the core, which then begins earlier, and of those that hold the other half behind it."""
    last, before = len(data) - span, -(-(span - core) // 2)
    if lead >= before:
        yield 0, data[: min(last, lead - before) + span], lead - before, core + before
    first = max(0, lead - before + 1)
    if first <= last:
        yield first, data[first:], lead - first, span - before + 1


def longer_keys(hot: DataFrame, span: int) -> DataFrame:
    """Contexts (anchor, context, count, lead, core, bytes) dealt to two groups each, their key of ``core`` bytes made longer:
    (of_anchor, of_context, offset, anchor, context, count, lead, core, bytes)."""
    schema = pa.schema([("of_anchor", pa.int64()), ("of_context", pa.binary()), ("offset", pa.int32()), ("anchor", pa.int64()), ("context", pa.binary()), ("count", pa.int64()), ("length", pa.int32()), ("lead", pa.int32()), ("core", pa.int32()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            rows = []
            for own, mark, count, lead, size, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                for offset, part, at, longer in halves(data, lead, size, span):
                    number = xxhash.xxh64_intdigest(part[at : at + longer], longer)
                    rows.append((own, mark, offset, number - ((number >> 63) << 64), context_digest(part, at), count, len(part), at, longer, part))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return hot.select("anchor", "context", "count", "lead", "core", "bytes").mapInArrow(run, "of_anchor long, of_context binary, offset int, anchor long, context binary, count long, length int, lead int, core int, bytes binary")


def covered_contexts(one: DataFrame, span: int, max_contexts: int) -> DataFrame:
    """(anchor, context, start, end): repeated spans of distinct contexts (anchor, context, count, lead, core, length, bytes)."""
    sizes = materialise(one.groupBy("anchor").agg(F.count("*").alias("_n")).withColumnRenamed("anchor", "_anchor"), "spans-sizes")
    sized = one.join(sizes, F.col("anchor") == F.col("_anchor")).drop("_anchor")
    covered = cover_groups(sized.where(F.col("_n").between(2, max_contexts)), span)
    covered = covered.union(sized.where("_n = 1 and count > 1").select("anchor", "context", F.lit(0).alias("start"), F.col("length").alias("end")))
    hot = materialise(sized.where(F.col("_n") > max_contexts).drop("_n", "length"), "spans-hot")
    if hot.isEmpty():
        return covered
    dealt = materialise(longer_keys(hot, span), "spans-dealt")
    forget(hot)
    # keys of one length have one group, so a key's bytes decide where a context goes; digests then tell contexts apart
    again = dealt.groupBy("anchor", "context").agg(F.sum("count").alias("count"), *[F.first(c).alias(c) for c in ("lead", "core", "length", "bytes")])
    found = covered_contexts(materialise(again, "spans-distinct"), span, max_contexts).withColumnsRenamed({"anchor": "_a", "context": "_c"})
    back = dealt.select("of_anchor", "of_context", "offset", "anchor", "context").join(found, (F.col("anchor") == F.col("_a")) & (F.col("context") == F.col("_c")))
    return covered.union(back.select(F.col("of_anchor"), F.col("of_context"), F.col("start") + F.col("offset"), F.col("end") + F.col("offset")))


def repeated_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """docs (key, text), key being a digest of the text: (key, spans) of every distinct text that
    loses bytes, spans being an array of (start, end) byte places, possibly overlapping. Texts
    that occur twice go as a whole and are not listed."""
    if span < 4 * BLOCK or gram >= span:
        raise ValueError(f"a span takes {4 * BLOCK} bytes or more, and an anchor fewer than a span")
    long = docs.where(F.octet_length("text") >= span)
    anchors = materialise(anchor_rows(long, span, gram), "spans-anchors")
    spot = F.xxhash64("key", "place")
    several = anchors.groupBy("anchor").agg(F.min(spot).alias("_a"), F.max(spot).alias("_b")).where("_a <> _b").select(F.col("anchor").alias("_anchor"))
    several = materialise(several, "spans-several")  # as a table of its own the join can split hot anchors
    # windows on both sides of a stretch's border can have one anchor place: they are contiguous
    kept = anchors.join(several, F.col("anchor") == F.col("_anchor"), "left_semi").groupBy("key", "place").agg(F.first("anchor").alias("anchor"), F.min("first").alias("first"), F.max("last").alias("last"))
    lists = kept.groupBy("key").agg(F.collect_list(F.struct("anchor", "place", "first", "last")).alias("anchors")).withColumnRenamed("key", "_key")
    texts = long.groupBy("key").agg(F.first("text").alias("text")).join(lists, F.col("key") == F.col("_key")).select("key", "text", "anchors")
    placed = materialise(context_rows(texts, span), "spans-contexts")
    forget(anchors)

    one = placed.groupBy("anchor", "context").agg(F.count("*").alias("count"), F.first("lead").alias("lead"), F.first("bytes", True).alias("bytes"), F.first("length").alias("length"))
    one = materialise(one.withColumn("core", F.lit(gram)), "spans-distinct")
    covered = covered_contexts(one, span, max_contexts).select(F.col("anchor").alias("_a"), F.col("context").alias("_c"), "start", "end")
    covered = materialise(covered, "spans-covered")
    return (
        placed.select("anchor", "context", "key", "first")
        .join(covered, (F.col("anchor") == F.col("_a")) & (F.col("context") == F.col("_c")))
        .groupBy("key")
        .agg(F.collect_list(F.struct((F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("end")).alias("end"))).alias("spans"))
    )


def keyed_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with null text as empty, and ``key``, the text's SHA-256 as binary."""
    filled = docs.withColumn(text, F.coalesce(text, F.lit("")))
    return filled.withColumn("key", F.unhex(F.sha2(F.col(text).cast("binary"), 256)))


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans drawn in to character boundaries of UTF-8."""
    out = []
    for start, end in spans:
        while start < end and start < len(data) and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def cut_texts(texts: DataFrame, spans: DataFrame, characters: bool = False) -> DataFrame:
    """(key, kept, n_removed, n_spans) of the distinct texts (key, text) that have spans; with
    ``characters``, only whole characters are cut, so that kept is valid UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            rows = []
            for key, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                cut = merged([(s["start"], s["end"]) for s in found])
                if characters:
                    cut = whole_characters(data, cut)
                edges = [0, *[e for pair in cut for e in pair], len(data)]
                rows.append((key, b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), sum(b - a for a, b in cut), len(cut)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int64(), pa.int64()))], names=["key", "kept", "n_removed", "n_spans"])

    joined = texts.groupBy("key").agg(F.first("text").alias("text")).join(spans.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"))
    return joined.select("key", "text", "spans").mapInArrow(run, "key binary, kept binary, n_removed long, n_spans long")


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, key: str = "doc_id", text: str = "text", characters: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two tables: every row of docs as (its key, digest of the text as ``key``, n_bytes), and for
    each text that loses bytes (``of``, kept, n_removed, n_spans)."""
    chosen = keyed_texts(need_columns(docs, key, text).withColumnsRenamed({key: "_id", text: "text"}))
    narrow = materialise(chosen.select(F.col("_id").alias(key), "key", F.octet_length("text").cast("long").alias("n_bytes")), "spans-rows")
    copies = narrow.where(F.col("n_bytes") >= span).groupBy("key").agg(F.count("*").alias("n"), F.first("n_bytes").alias("n_bytes")).where("n > 1")
    whole = copies.select(F.col("key").alias("of"), F.lit(b"").alias("kept"), F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"))
    spans = materialise(repeated_spans(chosen.select("key", "text"), span, gram), "spans-found")
    spans = spans.join(whole.select("of"), F.col("key") == F.col("of"), "left_anti")
    parts = cut_texts(chosen.select("key", "text"), spans, characters).withColumnRenamed("key", "of")
    return narrow, whole.union(parts)


def run_pieces(texts: DataFrame, spans: DataFrame, least: int) -> DataFrame:
    """(key, text): the merged spans (key, spans) of at least ``least`` bytes of texts (key, text), drawn out to whole characters, each as a
    text of its own; its key is that of its text and its place there in four bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            keys, pieces = [], []
            for key, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                for start, end in merged([(s["start"], s["end"]) for s in found]):
                    if end - start >= least:
                        start, end = drawn_out(data, start, end)
                        keys.append(key + start.to_bytes(4, "big"))
                        pieces.append(data[start:end].decode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(pieces, pa.string())], names=["key", "text"])

    long = texts.where(F.octet_length("text") >= least).groupBy("key").agg(F.first("text").alias("text"))
    return long.join(spans.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key")).select("key", "text", "spans").mapInArrow(run, "key binary, text string")


def drawn_out(data: bytes, start: int, end: int) -> tuple[int, int]:
    """A span drawn out to character boundaries of UTF-8."""
    while start and data[start] & 0xC0 == 0x80:
        start -= 1
    while end < len(data) and data[end] & 0xC0 == 0x80:
        end += 1
    return start, end


def longer_spans(texts: DataFrame, spans: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """What repeated_spans(texts, span, gram) returns, where ``spans`` is what it returns for fewer bytes: all parts of a repeated string
    are repeated, so only the runs of those spans are searched."""
    pieces = materialise(run_pieces(texts, spans, span), "spans-pieces")
    found = repeated_spans(pieces, span, gram)
    own, place = F.expr("substring(key, 1, octet_length(key) - 4)"), F.conv(F.hex(F.expr("substring(key, octet_length(key) - 3, 4)")), 16, 10).cast("int")
    moved = found.withColumns({"own": own, "place": place}).select(F.col("own").alias("key"), F.transform("spans", lambda s: F.struct((s["start"] + F.col("place")).alias("start"), (s["end"] + F.col("place")).alias("end"))).alias("spans"))
    return moved.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats_and_passages(docs: DataFrame, span: int = SPAN, gram: int = GRAM, passage: int = PASSAGE_BYTES, passage_gram: int = PASSAGE_GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of docs as (its key, n_bytes, kept, n_removed, n_spans, passages_cut): ``kept``, binary, is without the strings of
    ``span`` bytes that also start elsewhere, ``passages_cut``, a string, without those of ``passage`` bytes, fewer, whole characters only."""
    if passage > span:
        raise ValueError("a passage takes at most the bytes of a span")
    rows = keyed_texts(need_columns(docs, key, text).withColumnsRenamed({key: "_id", text: "text"}))
    texts = rows.select("key", "text")
    passages = materialise(repeated_spans(texts, passage, passage_gram), "spans-passages")
    spans = materialise(longer_spans(texts, passages, span, gram), "spans-found")
    copies = rows.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1").withColumnRenamed("key", "_copied")
    found = passages.select(F.col("key").alias("_of"), F.col("spans").alias("passages")).join(spans, F.col("_of") == F.col("key"), "left").drop("key")
    marks = found.join(copies, F.col("_of") == F.col("_copied"), "full").select(F.coalesce("_of", "_copied").alias("_key"), "spans", "passages", "copies")
    marks = materialise(marks, "spans-marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(data: bytes, found: list[dict] | None, whole: bool, characters: bool = False) -> tuple[bytes, list[tuple[int, int]]]:
            gone = [(0, len(data))] if whole else merged([(s["start"], s["end"]) for s in found or ()])
            gone = whole_characters(data, gone) if characters else gone
            edges = [0, *[e for pair in gone for e in pair], len(data)]
            return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), gone

        for batch in by_bytes(batches):
            out = []
            for value, repeats, shorter, n in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                data = value.encode()
                kept, gone = cut(data, repeats, bool(n) and len(data) >= span)
                left, _ = cut(data, shorter, bool(n) and len(data) >= passage, True)
                out.append((len(data), kept, sum(b - a for a, b in gone), len(gone), left.decode()))
            kinds = {"n_bytes": pa.int64(), "kept": pa.binary(), "n_removed": pa.int64(), "n_spans": pa.int64(), "passages_cut": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds.values()))], names=["_id", *kinds])

    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, n_bytes long, kept binary, n_removed long, n_spans long, passages_cut string"
    marked = rows.join(marks, F.col("key") == F.col("_key")).select("_id", "text", "spans", "passages", "copies").mapInArrow(run, schema)
    none = F.lit(0).cast("long")
    whole = rows.join(marks.select("_key"), F.col("key") == F.col("_key"), "left_anti").select("_id", F.octet_length("text").cast("long"), F.col("text").cast("binary"), none, none, "text")
    return marked.union(whole).withColumnRenamed("_id", key)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests, then the text that remains, as a string (a character of which only a part is cut stands there as U+FFFD), and last the text
    without passages of PASSAGE_BYTES, which the other columns leave where they are shorter than SPAN."""
    found = remove_repeats_and_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text.alias("text"), F.col("passages_cut").alias("text_without_passages"))
