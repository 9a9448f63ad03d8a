"""SimHash near-duplicates, found with BK-trees over shards of fingerprints.

A fingerprint bit is the majority of that bit over the XXH64 hashes of a text's word shingles.
Fingerprints within a Hamming radius are linked, and documents get the component of their
fingerprint. Equal fingerprints are one node, so copies never meet in pairs.

Every distinct fingerprint goes to one shard of each table, a table being a set of bit positions
whose values name the shard. Where the tables are all choices of ``blocks - radius`` out of
``blocks`` blocks of bits, two linked fingerprints agree in one table at least, so none is missed.
In a shard a BK-tree is grown, children keyed by their integer Hamming distance to the parent, and
only edges within the radius are followed. Fingerprints within half the radius of a node are
linked among themselves; they hang on the node as members, which are compared only where a newcomer
is near the node and not yet in its component. A shard of more than ``MAX_SHARD`` fingerprints is
cut into blocks, and each pair of blocks is a task's tree: no shard is gathered whole.

Trees are grown where the shuffle brings a shard together. They are not broadcast: that would take
the fingerprints of all documents through the driver, and their size is not bounded.

Defined cases: null and empty texts have the zero fingerprint, which is linked like any other.
Texts of fewer words than a shingle are one shingle. Repeated rows share their component. A null
doc_id is ignored in the smallest id of a component, unless there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, materialise, need_columns, partitions_for
from .components import connected_components

SEED = 42
#: The operator's words to a shingle, linking radius, and blocks of a fingerprint's 64 bits.
SHINGLE_WORDS, RADIUS, BLOCKS = 4, 4, 6
#: Fingerprints of one shard that one task compares.
MAX_SHARD = 4096
#: Shingles counted at a time.
STRETCH = 1 << 16
#: Odd constants that turn one 64-bit hash into further lanes.
LANES = (0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def block_tables(bits: int = 64, blocks: int = BLOCKS, radius: int = RADIUS) -> list[list[int]]:
    """All choices of blocks - radius blocks: exact for the radius."""
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    spans = [list(range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [sum(chosen, []) for chosen in combinations(spans, blocks - radius)]


def sampled_tables(bits: int, tables: int, width: int, seed: int = 1) -> list[list[int]]:
    """Tables of randomly drawn bits: two fingerprints that differ in a share p of their bits
    meet with probability 1 - (1 - (1 - p) ** width) ** tables."""
    rng = np.random.default_rng(seed)
    return [sorted(rng.choice(bits, width, replace=False).tolist()) for _ in range(tables)]


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included: A-Z lower-cased, split at ASCII white space."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, dtype="<u8")
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) < words:
        return np.array([digest(joined, SEED)], dtype="<u8")
    ends = list(accumulate(len(w) + 1 for w in found))
    return np.array([digest(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[words - 1 :])], dtype="<u8")


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> bytes:
    """Bits set in over half the hashes, as 8 * lanes bytes, most significant first."""
    table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
    counts = np.zeros((lanes, 8, 8), dtype=np.int64)
    for at in range(0, len(hashes), STRETCH):
        part = hashes[at : at + STRETCH]
        for lane in range(lanes):
            mixed = part
            if lane:
                mixed = part + np.uint64(LANES[lane])
                mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                mixed = mixed ^ (mixed >> np.uint64(31))
            columns = mixed.astype(">u8").view(np.uint8).reshape(-1, 8)
            for byte in range(8):
                counts[lane, byte] += np.bincount(columns[:, byte], minlength=256) @ table
    return np.packbits(counts.reshape(-1) * 2 > len(hashes)).tobytes() if len(hashes) else bytes(8 * lanes)


def simhash(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", words: int = SHINGLE_WORDS, lanes: int = 1) -> DataFrame:
    """The key columns and ``fp``, the fingerprint as binary."""
    chosen = need_columns(docs, *keys, text)
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields if f.name in keys], "fp binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            prints = [fingerprint(shingle_hashes(t, words), lanes) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(prints, pa.binary())], names=[*batch.schema.names[:-1], "fp"])

    return chosen.mapInArrow(run, ddl)


def grow_and_link(prints: list[int], radius: int) -> list[int]:
    """The component of each of a shard's distinct fingerprints, as the place of its first, by a
    BK-tree grown one fingerprint at a time."""
    parent = list(range(len(prints)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)

    half = radius // 2
    reach = radius + half
    children: list[dict[int, int]] = [{}]
    places, members = [0], [[]]  # of the tree's nodes: their fingerprint, and the members on them
    for x in range(1, len(prints)):
        value, stack, near, host = prints[x], [0], [], -1
        while stack:
            node = stack.pop()
            distance = (value ^ prints[places[node]]).bit_count()
            if distance <= reach:
                near.append(node)
                if distance <= radius:
                    join(x, places[node])
                if distance <= half:
                    host = node
            stack += [child for k, child in children[node].items() if distance - reach <= k <= distance + reach]
        for node in near:
            if members[node] and find(places[node]) != find(x):
                near_member = next((m for m in members[node] if (value ^ prints[m]).bit_count() <= radius), None)
                if near_member is not None:
                    join(x, near_member)
        if host >= 0:
            members[host].append(x)
            continue
        node = 0
        while True:
            exact = (value ^ prints[places[node]]).bit_count()
            if exact not in children[node]:
                children[node][exact] = len(places)
                children.append({})
                places.append(x)
                members.append([])
                break
            node = children[node][exact]
    return [find(i) for i in range(len(prints))]


def shard_rows(prints: DataFrame, tables: list[list[int]]) -> DataFrame:
    """(shard, fp): each fingerprint once for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(0)
            raw = np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
            bits = np.unpackbits(raw, axis=1)
            for number, positions in enumerate(tables):
                key = bits[:, positions].astype(np.int64) @ (np.int64(1) << np.arange(len(positions), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(key | (number << 40)), values], names=["shard", "fp"])

    return prints.select("fp").mapInArrow(run, "shard long, fp binary")


def link_shards(sharded: DataFrame, radius: int, max_shard: int = MAX_SHARD) -> DataFrame:
    """Edges (a, b) that connect, in each shard, what lies within the radius: a star for each
    component of a shard, so at most one edge for each of its fingerprints."""
    sharded = materialise(sharded, "simhash-shards")
    hot = materialise(sharded.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > max_shard).select(F.col("shard").alias("_hot"), F.ceil(F.col("n") / max_shard).cast("int").alias("_blocks")), "simhash-hot")
    dealt = sharded.withColumn("pair", F.lit(0).cast("long"))
    if hot.count():
        own = F.pmod(F.xxhash64("fp"), F.col("_blocks")).cast("long")
        other = F.explode(F.when(F.col("_blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("_blocks").cast("long") - 1)))
        dealt = (
            sharded.join(hot, F.col("shard") == F.col("_hot"), "left")
            .withColumn("_own", F.coalesce(own, F.lit(0).cast("long")))
            .withColumn("_other", other)
            .select("shard", "fp", (F.least("_own", "_other") * F.lit(1 << 20) + F.greatest("_own", "_other")).alias("pair"))
        )

    def link(group: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        roots = grow_and_link([int.from_bytes(p, "big") for p in group], radius)
        for i, root in enumerate(roots):
            if i != root:
                yield group[i], group[root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        key = None
        for batch in batches:
            edges: list[tuple[bytes, bytes]] = []
            shard, pair = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(pair) != 0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            prints = batch.column(2)
            for start, end in zip(bounds, bounds[1:]):
                if start == end:
                    continue
                here = (shard[start], pair[start])
                if here != key:
                    if len(held) > 1:
                        edges += link(held)
                    held, key = [], here
                if end - start == 1 and not held and end < batch.num_rows:
                    key = None  # a fingerprint alone in its shard
                    continue
                held += prints.slice(start, end - start).to_pylist()
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*edges)], names=["a", "b"])
        if len(held) > 1 and (edges := list(link(held))):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*edges)], names=["a", "b"])

    n = partitions_for(sharded.sparkSession)
    return dealt.select("shard", "pair", "fp").repartition(n, "shard", "pair").sortWithinPartitions("shard", "pair", "fp").mapInArrow(run, "a binary, b binary")


def near_duplicates(prints: DataFrame, tables: list[list[int]], radius: int, key: str = "doc_id") -> DataFrame:
    """prints (key, fp) with component_id, the least key of the fingerprints reachable."""
    first = materialise(prints.groupBy("fp").agg(F.min(key).alias("_first")), "simhash-distinct")
    edges = link_shards(shard_rows(first, tables), radius)
    found = connected_components(edges)
    rooted = first.join(found, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("_fp"), "_first", F.coalesce("root", "fp").alias("_root"))
    least = materialise(rooted.groupBy("_root").agg(F.min("_first").alias("component_id")).withColumnRenamed("_root", "_of"), "simhash-least")
    named = rooted.join(least, F.col("_root") == F.col("_of")).select("_fp", "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).drop("_fp")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = materialise(simhash(docs), "simhash-prints")
    linked = near_duplicates(prints, block_tables(), RADIUS)
    return linked.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
