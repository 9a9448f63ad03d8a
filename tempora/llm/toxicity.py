"""Toxicity scores by weak supervision.

Voters are words and word beginnings that labelled training rows show to mark toxic texts, a
seed lexicon, and surface patterns. A generative label model (latent class, fitted by expectation
maximisation on votes alone) estimates how often each voter fires under either label; voters that
remain correlated given the label share their weight. A linear classifier is trained on the
posterior labels, and scores every whole text.

The training sample has at most ``FIT_ROWS`` labelled doc_ids, the first by a hash, with one text each (the
least, where a doc_id repeats), and holds rows of the training folds only (crc32 of doc_id as text, mod 4, not 2). Mining and fitting
see nothing else. Votes of the sample, a few hundred bits a row, are all that reaches the driver.

Defined cases: null and empty texts fire no voter and get the classifier's base score. A very long text is one Python object of its task, whole. Without
usable labels the seed lexicon and patterns vote alone. Repeated rows are scored alike. Rows of
labels without a document, or with a null label, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, materialise, need_columns

#: Labelled rows used to mine voters and fit the models.
FIT_ROWS = 16_000
#: Voters mined, the toxic rows one must occur in, and the share of its rows that must be toxic.
MAX_VOTERS, MIN_TOXIC, MIN_SHARE = 400, 3, 0.9
#: Lengths of word beginnings that can vote.
BEGINNINGS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
HELD_OUT_FOLD, FOLDS = 2, 4

#: Words that vote without being mined. Fixed values.
SEEDS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown"]
WORDS = re.compile(r"[^\W_]+")
#: Surface patterns that vote: shouting, masked words, runs of exclamation marks. Fixed values.
PATTERNS = [("shouting", r"(?:\b[^\W\d_a-z]{3,}\b[\s!?]*){6,}"), ("masked", r"\b\w+[*@#$]+\w+\b"), ("exclaiming", r"!{3,}")]


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


@dataclass
class Voters:
    """Feature -> number; a feature is a word (``=word``) or a beginning (``4^word``)."""

    numbers: dict[str, int]

    @property
    def size(self) -> int:
        return len(self.numbers) + len(PATTERNS)

    def fire(self, text: str | None, patterns: list[re.Pattern]) -> tuple[list[int], int]:
        """Numbers of the voters that fire, and how many of the text's words made one fire."""
        if not text:
            return [], 0
        numbers, fired, hits = self.numbers, set(), 0
        for word, times in Counter(WORDS.findall(text.lower())).items():
            found = [n for key in ("=" + word, *[f"{k}^{word[:k]}" for k in BEGINNINGS if len(word) >= k]) if (n := numbers.get(key)) is not None]
            if found:
                fired.update(found)
                hits += times
        for k, pattern in enumerate(patterns):
            if pattern.search(text):
                fired.add(len(numbers) + k)
        return sorted(fired), hits


@dataclass
class ToxicityModel:
    voters: Voters
    weights: np.ndarray  # of the voters, then of log(1 + hits)
    bias: float

    def score(self, fired: list[int], hits: int) -> float:
        z = self.bias + self.weights[fired].sum() + self.weights[-1] * np.log1p(hits)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def mine_voters(sample: DataFrame, text: str = "text", max_voters: int = MAX_VOTERS) -> Voters:
    """Words and beginnings that mark toxic rows of sample (column ``toxic``)."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))

    def beginnings(k: int) -> Column:
        return F.transform(F.filter("_words", lambda w: F.length(w) >= k), lambda w: F.concat(F.lit(f"{k}^"), F.substring(w, 1, k)))

    parts = [F.transform("_words", lambda w: F.concat(F.lit("="), w))]
    parts += [beginnings(k) for k in BEGINNINGS]
    counted = (
        sample.select("toxic", words.alias("_words"))
        .select("toxic", F.explode(F.array_distinct(F.concat(*parts))).alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("rows"))
        .where((F.col("toxic") >= MIN_TOXIC) & ((F.col("toxic") + 0.5) / (F.col("rows") + 1) >= MIN_SHARE))
        .orderBy(F.desc("toxic"), F.length("feature"), "feature")
        .limit(max_voters)
    )
    chosen: list[str] = []
    for feature in [*(r.feature for r in counted.collect()), *(f"={w}" for w in SEEDS)]:
        kind, word = (0, feature[1:]) if feature[0] == "=" else (int(feature[0]), feature[2:])
        covered = any(f"{k}^{word[:k]}" in chosen for k in BEGINNINGS if k <= len(word) and k != kind)
        if not covered and feature not in chosen:  # a voter within another voter adds no evidence
            chosen.append(feature)
    return Voters({f: n for n, f in enumerate(chosen)})


def label_model(votes: np.ndarray, prior: float = 0.1, rounds: int = 60, least_right: float = 0.9) -> tuple[np.ndarray, dict]:
    """Posterior of the toxic label for each row of a 0/1 vote matrix, and what was estimated:
    prior, firing rates under either label, conditional correlations and voter weights.

    A voter that does not fire abstains; that none fires is one vote for the clean label, which a
    toxic row gets at most once in fifty times. The class prior is given, as in most such models:
    votes alone cannot tell a rare label from a common one."""
    votes = np.column_stack([votes, ~votes.any(axis=1)]).astype(float)
    n, m = votes.shape
    posterior = np.where(votes[:, -1] > 0, 0.01, 0.9)
    share, correlation = np.ones(m), np.eye(m)
    rate1 = rate0 = np.full(m, 0.5)
    for turn in range(2):
        for _ in range(rounds):
            up = posterior.sum()
            rate1 = (votes.T @ posterior + 0.1) / (up + 1)
            rate0 = (votes.T @ (1 - posterior) + 0.1) / (n - up + 1)
            rate1[-1] = min(rate1[-1], 0.02)
            # voters are taken to be right nine times in ten at least, as mining asks: a small group of voters that
            # fire together, as those of one language do, is then not explained as a clean class
            if least_right:
                rate0[:-1] = np.minimum(rate0[:-1], rate1[:-1] * prior / (1 - prior) * (1 - least_right) / least_right)
            logit = np.log(prior / (1 - prior)) + votes @ (share * (np.log(rate1) - np.log(rate0)))
            new = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
            moved = np.abs(new - posterior).max(initial=0)
            posterior = new
            if moved < 1e-6:
                break
        if turn == 0 and n:  # correlation that the label leaves unexplained splits a voter's weight
            residual = votes - np.outer(posterior, rate1) - np.outer(1 - posterior, rate0)
            scale = np.sqrt((residual**2).mean(axis=0)) + 1e-9
            correlation = (residual / scale).T @ (residual / scale) / n
            excess = np.maximum(correlation - np.eye(m) - 0.2, 0)
            share = np.maximum(0.65, 1 / (1 + excess.sum(axis=1)))
    return posterior, {"prior": prior, "fires_toxic": rate1, "fires_clean": rate0, "correlation": correlation, "weight": share}


def fit_linear(features: np.ndarray, target: np.ndarray, penalty: float = 1e-4, steps: int = 800) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch Adam, from zero."""
    n, m = features.shape
    w, b = np.zeros(m), 0.0
    m1, m2 = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, steps + 1):
        error = 1 / (1 + np.exp(-np.clip(features @ w + b, -40, 40))) - target
        grad = np.append(features.T @ error / n + penalty * w, error.mean())
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        step = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fire_all(rows: DataFrame, voters: Voters, text: str = "text") -> DataFrame:
    """Votes of each row (text, toxic): an array of voter numbers, the hits, and toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(p) for _, p in PATTERNS]
        for batch in by_bytes(batches):
            fired = [voters.fire(t, patterns) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in fired], pa.list_(pa.int32())), pa.array([h for _, h in fired], pa.int32()), batch.column(1)], names=["fired", "hits", "toxic"])

    return rows.select(text, "toxic").mapInArrow(run, "fired array<int>, hits int, toxic int")


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Fit on labelled rows of the training folds: docs (doc_id, text), labels (doc_id, toxic)."""
    usable = need_columns(labels, "doc_id", "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))
    # one row a doc_id, the first fit_rows of them by a hash
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(fit_rows)
    chosen = materialise(chosen.withColumnRenamed("doc_id", "_labelled"), "toxicity-labels")
    held = need_columns(docs, "doc_id", text).join(chosen, F.col("doc_id") == F.col("_labelled")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(text).alias(text))
    # near copies are one piece of evidence: rows that share their least sentence hash count once, by their least text
    sentences = F.filter(F.split(text, r"[.\n]"), lambda x: F.length(x) >= 30)
    sketch = F.coalesce(F.array_min(F.transform(sentences, lambda x: F.xxhash64(x))), F.xxhash64(text))
    sample = held.withColumn("_sketch", sketch).groupBy("_sketch", "toxic").agg(F.min(text).alias(text)).select(text, "toxic")
    sample = materialise(sample, "toxicity-sample")
    voters = mine_voters(sample, text)
    prior = float(sample.agg(F.avg("toxic")).first()[0] or 0.05)
    seen = fire_all(sample, voters, text).toPandas()
    # in an order of their own, so that sums do not depend on how Spark dealt the rows out
    seen = seen.iloc[sorted(range(len(seen)), key=lambda i: (list(seen["fired"].iat[i]), seen["hits"].iat[i], seen["toxic"].iat[i]))].reset_index(drop=True)
    votes = np.zeros((len(seen), voters.size))
    for i, fired in enumerate(seen["fired"]):
        votes[i, np.asarray(fired, dtype=int)] = 1
    # a voter that was not mined must show the same in the sample, or it is left out
    toxic = seen["toxic"].to_numpy(dtype=float)
    votes[:, (toxic @ votes + 0.5) / (votes.sum(axis=0) + 1) < 0.5] = 0
    posterior, _ = label_model(votes, min(0.5, max(0.005, prior)))
    if not len(seen):
        return ToxicityModel(voters, np.append(np.full(voters.size, 1.5), 0.0), -3.0)
    features = np.column_stack([votes, np.log1p(seen["hits"].to_numpy())])
    return ToxicityModel(voters, *fit_linear(features, posterior))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", keys: tuple[str, ...] = ("doc_id",), keep_text: bool = False) -> DataFrame:
    """The key columns, score and hits of every row; with ``keep_text`` the text too."""
    chosen = need_columns(docs, *keys, text)
    kept = [f for f in chosen.schema.fields if keep_text or f.name != text]
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "score double, hits int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(p) for _, p in PATTERNS]
        for batch in by_bytes(batches):
            scores, hits = [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                fired, n = model.voters.fire(value, patterns)
                scores.append(model.score(fired, n))
                hits.append(n)
            n = batch.num_columns if keep_text else batch.num_columns - 1
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n)], pa.array(scores, pa.float64()), pa.array(hits, pa.int32())], names=[*batch.schema.names[:n], "score", "hits"])

    return chosen.mapInArrow(run, ddl)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels)
    return score_toxicity(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "hits"
    )
