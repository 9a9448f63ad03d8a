"""Language identification by words first, then ever shorter character n-grams.

A word that some language knows costs each language minus the logarithm of its frequency there; a language that
does not know it pays a tenth of the frequency that one occurrence has in the largest language. A word that no
language knows is looked up by its n-grams, its ends marked, from ``LONGEST_GRAM`` characters down: the first
length of which some language knows any n-gram gives the mean of the known ones. Words no length knows cost the
same everywhere. The language of the least sum over all words of the whole text wins; the score is its share when
the sums are taken as log likelihoods.

Words are runs of letters and marks in lower case; those beyond ``LONGEST_WORD`` characters are looked up by
n-grams only. Models come from rows of the training folds (crc32 of doc_id as text, mod 4, not 2) that have a text
and a lang: about ``FIT_ROWS`` of each language at most, drawn by a hash of the text, equal texts once. The
``LANGUAGES`` commonest languages are learned, and of each language and length the commonest words or n-grams,
``FEATURES`` in all; frequencies are over all words of the sample. Spark counts them; the driver and each task hold
the chosen ones, a size that does not grow with the table.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; so is every text where nothing was
learned. Where languages cost the same the first in code point order wins. Repeated rows are judged alike. A very
long text, or one without white space, is one Python object of its task, whole. A null doc_id is in a training fold.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_bytes, forget, materialise, need_columns
from .toxicity import HELD_OUT_FOLD, fold

#: Rows drawn of each language, languages, and words and n-grams of all languages together in the models.
FIT_ROWS, LANGUAGES, FEATURES = 4_000, 256, 400_000
LONGEST_GRAM, LONGEST_WORD = 5, 40
#: Distinct pieces counted, or scores kept, at once in a task; bytes of text counted at once; words looked up at once;
#: and the longest piece whose score is kept.
HELD_WORDS, HELD_BYTES, WORDS_AT_ONCE, LONG_PIECE = 200_000, 64 << 20, 4096, 160
UNDETERMINED = "und"

WORDS = regex.compile(r"[\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


def words_in(chunk: str) -> list[str]:
    """The words of a lower-case piece of text without white space. Marks alone are no word."""
    return [w for w in WORDS.findall(chunk) if LETTER.search(w)]


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word, its ends marked by blanks; single characters without the blanks."""
    marked = word if n == 1 else f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """For each length (0: whole words), a number for each gram known; and in compressed rows, the languages that
    know it and what it costs them. ``unknown`` is the cost of a gram to the others, by length."""

    languages: list[str]
    numbers: list[dict[str, int]]
    starts: list[np.ndarray]
    knows: list[np.ndarray]
    cost: list[np.ndarray]
    unknown: np.ndarray

    def mean_costs(self, n: int, row: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
        """Mean cost to each language over the grams (row) of each owner; no owner is without one."""
        width = len(self.languages)
        first = self.starts[n][row]
        known = self.starts[n][row + 1] - first
        at = np.repeat(first - np.cumsum(known) + known, known) + np.arange(known.sum())
        cells = np.repeat(owner, known) * width + self.knows[n][at]
        saved = np.bincount(cells, self.cost[n][at] - self.unknown[n], owners * width).reshape(owners, width)
        return self.unknown[n] + saved / np.bincount(owner, minlength=owners)[:, None]

    def word_costs(self, words: list[str]) -> np.ndarray:
        """What each word costs each language."""
        out = np.full((len(words), len(self.languages)), self.unknown.max(initial=0))
        whole = np.array([self.numbers[0].get(w, -1) if len(w) <= LONGEST_WORD else -1 for w in words], dtype=np.int64)
        known = np.flatnonzero(whole >= 0)
        if len(known):
            out[known] = self.mean_costs(0, whole[known], np.arange(len(known)), len(known))
        rest = np.flatnonzero(whole < 0).tolist()
        for n in range(LONGEST_GRAM, 0, -1):
            number, rows, counts, hit, missed = self.numbers[n].get, [], [], [], []
            for i in rest:
                found = [r for g in grams_of(words[i], n) if (r := number(g)) is not None]
                if found:
                    rows += found
                    counts.append(len(found))
                    hit.append(i)
                else:
                    missed.append(i)
            if hit:
                out[hit] = self.mean_costs(n, np.array(rows), np.repeat(np.arange(len(hit)), counts), len(hit))
            rest = missed
        return out


class Judge:
    """Scores texts within one task; costs of pieces seen before are kept, a bounded number of them."""

    def __init__(self, model: LanguageModel):
        self.model, self.width = model, len(model.languages) + 1
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, self.width))

    def costs(self, chunks: list[str]) -> np.ndarray:
        """For each piece the sum over its words, and their number."""
        out = np.zeros((len(chunks), self.width))
        number: dict[str, int] = {}
        pairs = [(i, number.setdefault(w, len(number))) for i, chunk in enumerate(chunks) for w in words_in(chunk)]
        words = list(number)
        owner, word = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        order = np.argsort(word, kind="stable")
        owner, word = owner[order], word[order]
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = slice(*np.searchsorted(word, [at, at + WORDS_AT_ONCE]))
            costs = self.model.word_costs(words[at : at + WORDS_AT_ONCE])
            np.add.at(out[:, :-1], owner[some], costs[word[some] - at])
            np.add.at(out[:, -1], owner[some], 1)
        return out

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.model.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        if len(self.place) > HELD_WORDS:
            self.clear()
        place, new, seen = self.place, [], []
        for text in texts:
            places, times, long = [], [], []
            for chunk, n in Counter((text or "").lower().split()).items():
                if len(chunk) > LONG_PIECE:
                    long.append((chunk, n))
                    continue
                at = place.get(chunk)
                if at is None:
                    at = place[chunk] = len(place)
                    new.append(chunk)
                places.append(at)
                times.append(n)
            seen.append((places, times, long))
        if new:
            self.table = np.concatenate([self.table, self.costs(new)])
        return [self.verdict(*one) for one in seen]

    def verdict(self, places: list[int], times: list[int], long: list[tuple[str, int]]) -> tuple[str, float]:
        total = np.asarray(times, dtype=float) @ self.table[places] if places else np.zeros(self.width)
        for chunk, n in long:
            total = total + n * self.costs([chunk])[0]
        if not total[-1]:
            return UNDETERMINED, 0.0
        cost = total[:-1] - total[:-1].min()
        likely = np.exp(-np.minimum(cost * np.log(10), 700))
        best = int(cost.argmin())
        return self.model.languages[best], round(float(likely[best] / likely.sum()), 6)


def counted(sample: DataFrame) -> DataFrame:
    """(lang, n, gram, times) of a sample (lang, text): partial counts of words (n = 0) and n-grams."""

    def flush(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, chunks in held.items():
            words: dict[str, int] = defaultdict(int)
            for chunk, times in chunks.items():
                for word in words_in(chunk):
                    words[word] += times
            for n in range(LONGEST_GRAM + 1):
                grams: dict[str, int] = defaultdict(int)
                for word, times in words.items():
                    if n:
                        for g in grams_of(word, n):
                            grams[g] += times
                    elif len(word) <= LONGEST_WORD:
                        grams[word] += times
                if grams:
                    size = len(grams)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * size), pa.array(np.full(size, n, np.int32)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())], names=["lang", "n", "gram", "times"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0
        for batch in by_bytes(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(text.lower().split())
            size += batch.nbytes
            if size > HELD_BYTES or sum(map(len, held.values())) > HELD_WORDS:
                size = 0
                yield from flush(held)
        yield from flush(held)

    return sample.select("lang", "text").mapInArrow(run, "lang string, n int, gram string, times long")


def draw(docs: DataFrame, text: str, lang: str, fit_rows: int, languages: int) -> DataFrame:
    """(lang, text): the rows that models are learned from."""
    usable = need_columns(docs, "doc_id", text, lang).select("doc_id", F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))
    common = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select(F.col("lang").alias("_of"), F.col("count").alias("_rows"))
    line = F.lit(float(1 << 30)) * fit_rows / F.col("_rows")
    kept = usable.join(F.broadcast(common), F.col("lang") == F.col("_of")).where(F.pmod(F.xxhash64(F.lit("lang"), "text"), F.lit(1 << 30)) < line)
    return kept.select("lang", "text").dropDuplicates(["lang", "text"])


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS, languages: int = LANGUAGES, features: int = FEATURES) -> LanguageModel:
    """Models from docs (doc_id, text, lang)."""
    sums = materialise(counted(draw(docs, text, lang, fit_rows, languages)).groupBy("lang", "n", "gram").agg(F.sum("times").alias("times")), "language-counts")
    totals = {(r.lang, r.n): r.all for r in sums.groupBy("lang", "n").agg(F.sum("times").alias("all")).collect()}  # languages times lengths
    names = sorted({of for of, _ in totals})
    top = max(1, features // max(1, len(names) * (LONGEST_GRAM + 1)))
    order = Window.partitionBy("lang", "n").orderBy(F.desc("times"), "gram")
    chosen = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("n", "gram", "lang", "times").toArrow().to_pydict()
    forget(sums)
    spot = {name: i for i, name in enumerate(names)}
    lists: list[dict[str, list[tuple[int, float]]]] = [{} for _ in range(LONGEST_GRAM + 1)]
    for n, gram, of, times in sorted(zip(*(chosen[c] for c in ("n", "gram", "lang", "times")))):
        lists[n].setdefault(gram, []).append((spot[of], float(np.log10(totals[of, n] / times))))
    unknown = np.array([1 + np.log10(max([all_ for (_, m), all_ in totals.items() if m == n], default=1)) for n in range(LONGEST_GRAM + 1)])
    starts = [np.concatenate([[0], np.cumsum([len(x) for x in of.values()], dtype=np.int64)]).astype(np.int64) for of in lists]
    knows = [np.array([i for x in of.values() for i, _ in x], dtype=np.int32) for of in lists]
    cost = [np.array([c for x in of.values() for _, c in x], dtype=np.float64) for of in lists]
    return LanguageModel(names, [{g: i for i, g in enumerate(of)} for of in lists], starts, knows, cost, unknown)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The key columns, lang_pred and score of every row."""
    chosen = need_columns(docs, *keys, text)
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]], "lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in by_bytes(batches):
            last = batch.num_columns - 1
            found = judge.judge(batch.column(last).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(last)], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*batch.schema.names[:last], "lang_pred", "score"])

    return chosen.mapInArrow(run, ddl)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit_languages(docs)).select("doc_id", (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "lang_pred", "score")
