"""Vector code compression: codebooks of vector parts by Elkan's form of Lloyd's rounds, in whole numbers.

Every component x becomes floor(scale * x), and a vector is cut into equal parts, each position of which has a
codebook of its own. Each row keeps, for each part, its entry, an upper bound of the distance to it, and a lower
bound of the distance to every entry. These bounds are written as a table after each round and read by the next,
which shifts them by how far the entries have moved. An entry is left out only where a bound shows that it is
strictly farther (the lower bound, or half its distance from the current entry, is above the upper bound); all
others are compared by squared distances in whole numbers, ties going to the lower index. Bounds are single
floats, rounded away from the truth, so that no rounding leaves out an entry that could win.

Tasks give sums by entry and position, a fixed number whatever their rows. The driver holds the codebooks only.

Defined cases: rows whose vector is null or holds a null or non-finite component are dropped. So are vectors
whose length is not the commonest among those that can be cut (the longer on ties), and empty ones. Components
beyond ``magnitude_limit`` in size (some 32,000 before scaling, for 64 components) count as that limit. Repeated
rows are rows of their own. Of rows with one id, those of smaller components are the first entries; null ids come
last. Fewer rows than entries give as many entries as rows. An empty table gives an empty result. Extra columns
are ignored; a null label is a label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, materialise
from .integer_vectors import GroupSums, floor_means, floored, rows_of, with_total, within_limit

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
STATE = "_key {key}, _label {label}, whole array<int>, chosen array<int>, upper array<float>, lower array<float>"


def rounded_up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x, dtype=np.float64).astype(np.float32), np.float32(np.inf))


def rounded_down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.asarray(x, dtype=np.float64).astype(np.float32), np.float32(-np.inf)), np.float32(0))


def squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to the entry beside each."""
    return ((rows - entries) ** 2).sum(axis=-1)


def moved_up(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far entries moved, not below the truth."""
    return np.nextafter(np.sqrt(squares(old, new).astype(np.float64)), np.inf)


def first_bounds(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each row, and the bounds, all distances being computed."""
    far = np.stack([squares(rows, entry) for entry in book], axis=1)
    chosen = far.argmin(axis=1)
    root = np.sqrt(far.astype(np.float64))
    return chosen, rounded_up(root[np.arange(len(rows)), chosen]), rounded_down(root)


def shifted_bounds(chosen: np.ndarray, upper: np.ndarray, lower: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds that hold after entry j has moved by at most shift[j]."""
    up = np.nextafter(upper.astype(np.float64) + shift[chosen], np.inf)
    down = np.nextafter(lower.astype(np.float64) - shift, -np.inf)
    return np.where(shift[chosen] > 0, rounded_up(up), upper), np.where(shift > 0, rounded_down(down), lower)


def elkan_step(rows: np.ndarray, book: np.ndarray, chosen: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entry of each row from bounds that hold, the bounds tightened, and the number of distances computed."""
    chosen, upper, lower = chosen.copy(), upper.copy(), lower.copy()
    half = rounded_down(np.sqrt(np.stack([squares(book, entry) for entry in book]).astype(np.float64)) / 2)
    numbers = np.arange(len(book))
    open_ = (lower <= upper[:, None]) & (half[chosen] <= upper[:, None]) & (numbers != chosen[:, None])
    some = np.flatnonzero(open_.any(axis=1))
    best = squares(rows[some], book[chosen[some]])
    computed = len(some)
    root = np.sqrt(best.astype(np.float64))
    upper[some] = rounded_up(root)
    lower[some, chosen[some]] = rounded_down(root)
    for j in numbers:
        now = chosen[some]
        near = np.flatnonzero((lower[some, j] <= upper[some]) & (half[now, j] <= upper[some]) & (now != j))
        at = some[near]
        far = squares(rows[at], book[j])
        computed += len(at)
        root = np.sqrt(far.astype(np.float64))
        lower[at, j] = rounded_down(root)
        wins = (far < best[near]) | ((far == best[near]) & (j < chosen[at]))
        chosen[at[wins]], upper[at[wins]], best[near[wins]] = j, rounded_up(root[wins]), far[wins]
    return chosen, upper, lower, computed


def assigned(state: DataFrame, books: np.ndarray, shift: np.ndarray | None, schema: str) -> DataFrame:
    """state with entries and bounds for these codebooks; shift None where state has neither yet."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            rows = rows_of(batch.column(2)).reshape(n, parts, width)
            chosen, upper, lower = np.zeros((n, parts), np.int32), np.zeros((n, parts), np.float32), np.zeros((n, parts, entries), np.float32)
            if shift is not None:
                was = rows_of(batch.column(3))
                highest = batch.column(4).flatten().to_numpy().reshape(n, parts)
                lowest = batch.column(5).flatten().to_numpy().reshape(n, parts, entries)
            for p in range(parts):
                if shift is None:
                    chosen[:, p], upper[:, p], lower[:, p] = first_bounds(rows[:, p], books[p])
                else:
                    up, down = shifted_bounds(was[:, p], highest[:, p], lowest[:, p], shift[p])
                    chosen[:, p], upper[:, p], lower[:, p], _ = elkan_step(rows[:, p], books[p], was[:, p], up, down)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x[0].size) for x in (chosen, upper, lower)]
            lists = [x.cast(pa.list_(x.type.value_type)) for x in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], *lists], names=["_key", "_label", "whole", "chosen", "upper", "lower"])

    return state.mapInArrow(run, schema)


def entry_sums(state: DataFrame, parts: int, entries: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = GroupSums(parts * entries, width)
        for batch in batches:
            if batch.num_rows:
                cells = rows_of(batch.column(1)) + np.arange(parts) * entries
                sums.add(rows_of(batch.column(0)).reshape(-1, width), cells.ravel())
        yield from sums.batches()

    return state.select("whole", "chosen").mapInArrow(run, GroupSums.SCHEMA)


def codes(state: DataFrame, books: np.ndarray, schema: str) -> DataFrame:
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chosen = rows_of(batch.column(3))
                rows = rows_of(batch.column(2)).reshape(-1, parts, width)
                error = squares(rows, books[np.arange(parts), chosen]).sum(axis=1)
                code = ["".join(f"{c:02x}" for c in one) for one in chosen.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code), pa.array(error)], names=["_key", "_label", "code", "error"])

    return state.mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every vector that takes part."""
    spark = vectors.sparkSession
    whole = floored(vectors, scale, vector, key, label).select(F.col(key).alias("_key"), F.col(label).alias("_label"), "whole")
    lengths = whole.groupBy(F.size("whole").alias("length")).count().where((F.col("length") > 0) & (F.col("length") % parts == 0))
    top = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    kinds = [whole.schema[c].dataType.simpleString() for c in ("_key", "_label")]
    out = F.col("_key").alias(key), "code", "error", "label_error", "codebooks_sha256"
    if top is None:
        return spark.createDataFrame([], f"_key {kinds[0]}, code string, error long, label_error long, codebooks_sha256 string").select(*out)
    length, width = top.length, top.length // parts
    state = materialise(whole.where(F.size("whole") == length).withColumn("whole", within_limit(F.col("whole"), length)), "codes-rows")
    first = state.select("_key", "whole").orderBy(F.col("_key").asc_nulls_last(), "whole").limit(entries).collect()
    first.sort(key=lambda r: (r._key is None, r._key if r._key is not None else 0, r.whole))
    books = np.array([r.whole for r in first], dtype=np.int64).reshape(len(first), parts, width).swapaxes(0, 1).copy()
    schema, shift = STATE.format(key=kinds[0], label=kinds[1]), None
    for turn in range(rounds + 1):
        if shift is not None and not shift.any():
            break  # no entry moved: what follows would change nothing
        before, state = state, materialise(assigned(state, books, shift, schema), f"codes-state{turn}")
        forget(before)
        if turn < rounds:
            new = floor_means(entry_sums(state, parts, len(first), width), books.reshape(-1, width)).reshape(books.shape)
            shift = np.where((new != books).any(axis=2), moved_up(books, new), 0.0)
            books = new
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = materialise(codes(state, books, f"_key {kinds[0]}, _label {kinds[1]}, code string, error long"), "codes")
    forget(state)
    return with_total(coded, "_label", "error", "label_error").withColumn("codebooks_sha256", F.lit(digest)).select(*out)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def codes_sql() -> str:
    """The rounds written out as common table expressions, over parts of vectors of 64 components."""
    width = 64 // PARTS
    distance = "CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"pieces AS (SELECT vec_id, p, w[p * {width} + 1 : (p + 1) * {width}] AS v FROM kept, range({PARTS}) AS r(p))",
        f"firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}))",
        "c0 AS (SELECT p, e, v FROM firsts JOIN pieces USING (vec_id))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS (SELECT vec_id, k.p, k.v, e, {distance} AS d FROM pieces k JOIN c{r} c ON k.p = c.p QUALIFY row_number() OVER (PARTITION BY vec_id, k.p ORDER BY d, e) = 1)")
        if r < ROUNDS:
            mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
            steps.append(f"m{r} AS (SELECT p, e, list({mean} ORDER BY i) AS v FROM (SELECT p, e, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {width + 1}) AS q(i) GROUP BY p, e, i) GROUP BY p, e)")
            steps.append(f"c{r + 1} AS (SELECT c{r}.p, c{r}.e, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.p = m{r}.p AND c{r}.e = m{r}.e)")
    steps.append(f"coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id)")
    last = f"""SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM c{ROUNDS}) AS codebooks_sha256 FROM coded JOIN kept USING (vec_id)"""
    return "WITH " + ",\n".join(steps) + "\n" + last


OP12_SQL = codes_sql()
