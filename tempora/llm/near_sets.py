"""Near-duplicates by SimHash and the Jaccard similarity of shingle sets: every link confirmed.

1. Texts become sets of distinct shingle hashes; equal sets are one node, so copies never meet. A node has a SimHash
   fingerprint of its set.
2. Nodes whose fingerprints BK-trees over shards link, as in simhash, are tied. So are, for pairs beyond that radius, nodes that
   agree in a band of MinHash values, in a star to the least of them. The components of the ties are clusters.
3. Each cluster's sets are brought together once, and linked wherever their similarity is high
   enough: all pairs of a cluster are judged, not only those that met. A set that is linked leaves
   the sets still to be reached, so a cluster of near copies costs little more than one sweep.
   Clusters of more than ``MAX_SHINGLES`` are cut into blocks, and each pair of blocks is a task.
4. Components of the confirmed links are the groups.

Two sets of similarity s meet with probability 1 - (1 - s ** ROWS) ** BANDS: 1 - 5e-7 at 0.8.

Defined cases: null and empty texts are the empty set, which equals itself only. Texts of fewer words than a
shingle are one shingle. Of a group the row of least key is named, a null key only where there is no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, materialise, partitions_for
from .components import connected_components
from .simhash import RADIUS, block_tables, fingerprint, link_shards, shard_rows, shingle_hashes

#: MinHash values to a band, and bands.
ROWS, BANDS = 6, 48
#: Shingles of the sets of one block.
MAX_SHINGLES = 1 << 20
#: Shingles hashed at a time.
STRETCH = 1024


def multipliers(seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 31, (ROWS * BANDS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct hashes in order."""
    return np.unique(shingle_hashes(text, words))


def set_digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def band_keys(found: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    low = np.full(len(factors), 2**32 - 1, dtype=np.uint32)
    values = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(values), STRETCH):
        np.minimum(low, (factors * values[at : at + STRETCH]).min(axis=1), out=low)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for column in low.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def print_rows(docs: DataFrame, words: int) -> DataFrame:
    """docs (key, digest, text) as (key, digest, node, size, bands, fp)."""
    kind = docs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers()
        for batch in by_bytes(batches):
            sets = [shingle_set(t.as_py(), words) for t in batch.column(2)]
            keys = [band_keys(s, factors).view(np.int64) for s in sets]
            flat = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * BANDS, np.concatenate([*keys, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), flat, pa.array([fingerprint(s) for s in sets], pa.binary())], names=["key", "digest", "node", "size", "bands", "fp"])

    return docs.select("key", "digest", "text").mapInArrow(run, f"key {kind}, digest binary, node binary, size long, bands array<long>, fp binary")


def fingerprint_ties(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) of nodes (node, fp) whose fingerprints are equal or linked within the radius by the BK-trees of their shards: a star for each
    fingerprint, and one edge for each link."""
    firsts = materialise(nodes.groupBy("fp").agg(F.min("node").alias("_first")), "sets-fingerprints")
    links = materialise(link_shards(shard_rows(firsts, block_tables()), RADIUS), "sets-links")
    named = firsts.withColumnRenamed("fp", "_fp")
    near = links.join(named, F.col("a") == F.col("_fp")).select(F.col("_first").alias("_a"), "b").join(named, F.col("b") == F.col("_fp")).select(F.col("_a").alias("a"), F.col("_first").alias("b"))
    same = nodes.select("node", "fp").join(named, F.col("fp") == F.col("_fp")).where("node <> _first").select(F.col("node").alias("a"), F.col("_first").alias("b"))
    return near.union(same)


def set_rows(texts: DataFrame, words: int) -> DataFrame:
    """texts (root, blocks, node, text) as (root, blocks, node, found)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            sets = [shingle_set(t.as_py(), words).view(np.int64) for t in batch.column(3)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.ListArray.from_arrays(ends, np.concatenate([*sets, np.zeros(0, np.int64)]))], names=["root", "blocks", "node", "found"])

    return texts.select("root", "blocks", "node", "text").mapInArrow(run, "root binary, blocks long, node binary, found array<long>")


def link_sets(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Pairs of places that connect all sets whose similarity is ``least`` or more: a tree for
    each component. Sets have distinct values."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    _, flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(int(flat.max(initial=0)) + 1, dtype=bool)
    left, out = np.ones(len(sets), dtype=bool), []  # left: not reached yet
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first] = False
        queue = [first]
        while queue:
            x = queue.pop()
            low, high = np.searchsorted(sizes, [least * sizes[x] - 1e-6, sizes[x] / least + 1e-6])
            near = np.flatnonzero(left[low:high]) + low
            if not len(near):
                continue
            own = flat[starts[x] : starts[x + 1]]
            mark[own] = True
            if len(near) == high - low:
                hit = mark[flat[starts[low] : starts[high]]]
            else:
                hit = mark[np.concatenate([flat[starts[j] : starts[j + 1]] for j in near])]
            mark[own] = False
            sums = np.concatenate([[0], np.cumsum(hit)])
            ends = np.cumsum(sizes[near])
            both = sums[ends] - sums[ends - sizes[near]]
            # in whole numbers, so that a similarity of just ``least`` is no matter of rounding
            linked = near[both >= least * (sizes[x] + sizes[near] - both) - 1e-9]
            left[linked] = False
            queue += linked.tolist()
            out += [(int(order[j]), int(order[x])) for j in linked]
    return out


def confirmed_links(dealt: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) of rows (root, pair, node, found), judged within each (root, pair)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[bytes] = []
        sets: list[np.ndarray] = []
        now = None

        def close() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1 and (links := link_sets(sets, least)):
                yield pa.RecordBatch.from_arrays([pa.array([nodes[p[i]] for p in links], pa.binary()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for i, place in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if place != now:
                    yield from close()
                    nodes, sets, now = [], [], place
                nodes.append(batch.column(2)[i].as_py())
                sets.append(batch.column(3)[i].values.to_numpy().copy())
        yield from close()

    n = partitions_for(dealt.sparkSession)
    return dealt.select("root", "pair", "node", "found").repartition(n, "root", "pair").sortWithinPartitions("root", "pair").mapInArrow(run, "a binary, b binary")


def similar_groups(docs: DataFrame, words: int, least: float, max_shingles: int | None = None) -> DataFrame:
    """docs (key, digest, text), digest being that of the text: (key, digest, node, group), group
    being the same for rows that links of similarity ``least`` or more connect."""
    most = MAX_SHINGLES if max_shingles is None else max_shingles
    prints = materialise(print_rows(docs, words), "sets-prints")
    # one text stands for each node
    nodes = materialise(prints.groupBy("node").agg(F.min("digest").alias("of"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("fp").alias("fp")).where("size > 0"), "sets-nodes")
    met = nodes.select("node", F.explode("bands").alias("band"))
    stars = materialise(met.groupBy("band").agg(F.min("node").alias("b"), F.max("node").alias("_z")).where("b <> _z").select(F.col("band").alias("_band"), "b"), "sets-stars")
    ties = met.join(stars, F.col("band") == F.col("_band")).where("node <> b").select(F.col("node").alias("a"), "b")
    clusters = connected_components(fingerprint_ties(nodes).union(ties))
    held = materialise(clusters.join(nodes.select(F.col("node").alias("_node"), "of", "size"), F.col("node") == F.col("_node")).select("node", "root", "of", "size"), "sets-clusters")
    blocks = materialise(held.groupBy("root").agg(F.ceil(F.sum("size") / most).cast("long").alias("blocks")).withColumnRenamed("root", "_root"), "sets-blocks")
    wanted = materialise(held.join(blocks, F.col("root") == F.col("_root")).select("node", "root", "of", "blocks"), "sets-wanted")
    texts = docs.groupBy("digest").agg(F.first("text").alias("text"))  # before the join, so that copies do not meet there
    sets = set_rows(texts.join(wanted, F.col("digest") == F.col("of")), words)
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    sets = sets.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = sets.withColumn("pair", F.least("_own", "_other") * F.lit(1 << 31) + F.greatest("_own", "_other"))
    found = connected_components(confirmed_links(dealt, least))
    return prints.join(found.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select("key", "digest", "node", F.coalesce("root", "node").alias("group"))
