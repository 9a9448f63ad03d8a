"""Licence scans with a positional rare-token index (native).

Licence templates are passages of licence texts and notices. All their words, with inverse document frequencies
counted over the whole corpus, form a positional index: word -> (template, position, share of the template's
weight). Of each file every indexed word is looked up; a hit at place i for a posting at position p votes for the
template at place i - p with its share, so that rare words decide. The votes of one template and place are
intersected by adding up the shares of the positions that agree; where they reach ``min_share`` and a mandatory key
phrase of the template stands at its place, the file gets the template's label. A file votes for those templates only
of which it holds a key phrase. Base phrases are found at every place, whatever their frequency.

The texts are read once. That pass writes each file's licence words with their places; document frequencies, votes
and phrases all come from that table. A vote is four numbers, and a key phrase found is one more vote, so the one
shuffle of votes grows with the licence words of the files that hold a key phrase, however long one of them is.

Defined cases: null text has no words; empty text neither; both give n_words 0, no labels and
score 0. Repeated rows are scanned one by one. A very long text is one row of two arrays, as long as its
licence words are many. Columns of docs that are named like one of the result are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, materialise, need_columns
from .license_texts import BASE, TEMPLATES

#: What stands between words, and the same without the blank. Words are runs of digits, letters and anything
#: beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
NO_BLANK = r"[\x00-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: Share of a template's weight that must agree at one place, and the whole numbers in which shares are added up.
MIN_SHARE, SHARE_UNIT = 0.6, 1_000_000_000
OUT = ["n_words", "base_starts", "base_labels", "labels", "score"]


def file_words(text: Column) -> Column:
    """The words of a text, case kept. Anything between words becomes one blank, so that a plain split is left."""
    spaced = F.trim(F.regexp_replace(text, f" *{NO_BLANK}{BETWEEN}*| {{2,}}", " "))
    return F.when(spaced != "", F.split(spaced, " ")).otherwise(F.array().cast("array<string>"))


def vocabulary() -> list[str]:
    return sorted({w for _, passage, _ in TEMPLATES for w in passage.split()} | {w for phrase, _ in BASE for w in phrase.split()})


def licence_words(docs: DataFrame, text: str) -> DataFrame:
    """docs without the text, with _row, n_words, and the licence words of each file in order: _words
    and their _places. The one pass over the texts; all that follows is narrow."""
    vocab = vocabulary()
    # lower() is quick but folds a few characters beyond A-Z too, so what it finds is looked at again
    likely = F.filter(F.transform("_all", lambda w, i: F.when(F.lower(w).isin(vocab), F.struct(w.alias("word"), i.alias("place")))), lambda h: h.isNotNull())
    sure = F.filter(F.transform("_likely", lambda h: F.struct(lower_ascii(h.word).alias("word"), h.place.alias("place"))), lambda h: h.word.isin(vocab))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    found = docs.withColumn("_all", file_words(F.col(f"`{text}`"))).withColumn("_likely", likely)
    found = found.select(F.monotonically_increasing_id().alias("_row"), *kept, F.size("_all").cast("long").alias("n_words"), sure.alias("_hits"))
    return found.withColumn("_words", F.col("_hits.word")).withColumn("_places", F.col("_hits.place")).drop("_hits")


def word_idf(words: DataFrame, vocab: list[str]) -> dict[str, float]:
    """ln((1 + files) / (1 + files with the word)) of each licence word, over all rows of words
    (column ``_words``, the licence words of a file). Bounded by the vocabulary."""
    total = words.count()
    seen = {r.word: r.n for r in words.select(F.explode(F.array_distinct("_words")).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: math.log((1 + total) / (1 + seen.get(w, 0))) + 1e-6 for w in vocab}


def phrase_starts(phrase: list[str], anchor: int) -> Column:
    """Starts of a phrase in a file (_words, _places), tried at each hit of its anchor word. All words of
    a phrase are licence words, so its places lie side by side in the two arrays."""
    words, places, n = F.col("_words"), F.col("_places"), len(phrase)

    def start(word: Column, i: Column) -> Column:
        first = i - anchor
        fits = (word == phrase[anchor]) & (first >= 0) & (F.slice(words, first + 1, n) == F.array(*[F.lit(w) for w in phrase]))
        return F.when(fits & (F.get(places, first + (n - 1)) - F.get(places, first) == n - 1), F.get(places, first))

    tried = F.filter(F.transform(words, start), lambda s: s.isNotNull())
    return F.when(F.array_contains("_distinct", phrase[anchor]), tried).otherwise(F.array().cast("array<int>"))


def shares(passage: list[str], idf: dict[str, float]) -> list[int]:
    """The share of each position in a passage's weight, in whole ``SHARE_UNIT``s."""
    weight = sum(idf[w] for w in passage)
    return [round(idf[w] / weight * SHARE_UNIT) for w in passage]


def scan_licenses(docs: DataFrame, text: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """docs' columns but the text, with n_words, base_starts (array), base_labels (array), labels
    (array) and score."""
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c != text and c not in OUT]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{text}`").alias("text")) if keep else docs.select(F.struct(F.lit(0)).alias("kept"), F.col(f"`{text}`").alias("text"))
    words = materialise(licence_words(held, "text"), "license-words")
    idf = word_idf(words, vocabulary())

    def rarest(phrase: list[str]) -> int:
        return max(range(len(phrase)), key=lambda k: (idf[phrase[k]], phrase[k], -k))

    split = {p: p.split() for p in sorted({p for p, _ in BASE} | {p for _, _, ps in TEMPLATES for p in ps})}
    postings, keys = [], {}
    for t, (_, passage, musts) in enumerate(TEMPLATES):
        ws = passage.split()
        postings += [(w, t, k, share) for k, (w, share) in enumerate(zip(ws, shares(ws, idf)))]
        for p in musts:  # a key phrase stands at its first place in the passage
            keys.setdefault(p, []).append((t, next(i for i in range(len(ws)) if ws[i : i + len(split[p])] == split[p])))
    starts = F.array(*[F.struct(F.lit(p).alias("phrase"), phrase_starts(ws, rarest(ws)).alias("at")) for p, ws in split.items()])
    base = {p: label for p, label in BASE}
    at_base = F.flatten(F.transform(F.filter("_starts", lambda s: s.phrase.isin(list(base))), lambda s: s["at"]))
    base_label = F.create_map(*[F.lit(x) for pair in BASE for x in pair])
    narrow = words.withColumn("_distinct", F.array_distinct("_words")).withColumn("_starts", F.filter(starts, lambda s: F.size(s["at"]) > 0)).select(
        "_row",
        "kept",
        "n_words",
        at_base.alias("base_starts"),
        F.array_distinct(F.transform(F.filter("_starts", lambda s: s.phrase.isin(list(base))), lambda s: base_label[s.phrase])).alias("base_labels"),
        F.filter("_starts", lambda s: s.phrase.isin(list(keys))).alias("_starts"),
        F.when(F.exists("_starts", lambda s: s.phrase.isin(list(keys))), F.arrays_zip("_words", "_places")).alias("_hits"),
    )
    narrow = materialise(narrow, "license-scan")

    # tables of the templates, which are fixed, broadcast
    posted = F.broadcast(spark.createDataFrame(postings, "_word string, _template int, _position int, _share long"))
    keyed = F.broadcast(spark.createDataFrame([(p, t, k) for p, at in keys.items() for t, k in at], "_phrase string, _template int, _position int"))
    holders = narrow.where(F.size("_starts") > 0)
    of = {p: [t for t, _ in at] for p, at in keys.items()}
    template_map = F.create_map(*[x for p, ts in sorted(of.items()) for x in (F.lit(p), F.array(*[F.lit(t) for t in ts]))])
    present = F.array_distinct(F.flatten(F.transform("_starts", lambda s: template_map[s.phrase])))
    hits = holders.select("_row", present.alias("_present"), F.explode("_hits").alias("_h")).select("_row", "_present", F.col("_h._words").alias("_word"), F.col("_h._places").alias("_place"))
    by_word = hits.join(posted, "_word").where(F.array_contains("_present", F.col("_template"))).select("_row", "_template", (F.col("_place") - F.col("_position")).alias("_at"), "_share", F.lit(0).alias("_key"))
    found = holders.select("_row", F.explode("_starts").alias("_s")).select("_row", F.col("_s.phrase").alias("_phrase"), F.explode("_s.at").alias("_place"))
    by_phrase = found.join(keyed, "_phrase").select("_row", "_template", (F.col("_place") - F.col("_position")).alias("_at"), F.lit(0).cast("long").alias("_share"), F.lit(1).alias("_key"))
    votes = by_word.unionByName(by_phrase).groupBy("_row", "_template", "_at").agg(F.sum("_share").alias("_share"), F.max("_key").alias("_key")).where((F.col("_share") >= round(min_share * SHARE_UNIT)) & (F.col("_key") == 1))
    label_of = F.element_at(F.array(*[F.lit(label) for label, _, _ in TEMPLATES]), F.col("_template") + 1)
    labelled = votes.groupBy(F.col("_row").alias("_of")).agg(F.collect_set(label_of).alias("_labels"), F.least(F.max("_share") / SHARE_UNIT, F.lit(1.0)).alias("_score"))
    none = F.array().cast("array<string>")
    return narrow.join(labelled, F.col("_row") == F.col("_of"), "left").select(
        *[F.col(f"kept.`{c}`").alias(c) for c in keep],
        "n_words",
        "base_starts",
        F.array_sort("base_labels").alias("base_labels"),
        F.array_sort(F.array_union("base_labels", F.coalesce("_labels", none))).alias("labels"),
        F.greatest(F.coalesce("_score", F.lit(0.0)), F.when(F.size("base_labels") > 0, 0.5).otherwise(0.0)).alias("score"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = need_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("base_starts").cast("long").alias("n_base"),
        F.array_min("base_starts").cast("long").alias("first_word"),
        F.array_max("base_starts").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
