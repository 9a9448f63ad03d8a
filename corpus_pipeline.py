"""The corpus pipeline: toxicity, near-duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet in
the shared folder and reads it again for the next. All but the last return the columns of
documents; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import materialise
from tempora.llm.mixing import mix_sources, word_count
from tempora.llm.near_sets import similar_groups
from tempora.llm.packing import default_tokenizer, pack_documents
from tempora.llm.substring_dedup import remove_repeats
from tempora.llm.toxicity import THRESHOLD, fit_toxicity, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near-duplicates: words to a shingle, and the Jaccard similarity of the sets of shingles from which
#: documents are linked.
SHINGLE_WORDS, LEAST_SIMILARITY = 5, 0.8
#: Repeated passages of this many bytes are cut, about fifty short words.
PASSAGE_BYTES, PASSAGE_GRAM = 240, 64


def documents_of(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in COLUMNS])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold stay; labels teach the model, as in the operator. Null and empty texts fire no
    voter and stay; a very long text is scored whole; repeated rows fare alike, and ties at the threshold go. An empty
    table, or one without labels, has its lexicon and patterns only."""
    docs = documents_of(docs)
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model, keys=tuple(c for c in COLUMNS if c != "text"), keep_text=True).where(F.col("score") < THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of least doc_id (null ids last), and of equal ids of least digest. Null and
    empty texts are one text. Repeated rows of an id are one. A very long text is compared whole."""
    docs = documents_of(docs).withColumn("_digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
    grouped = similar_groups(docs.select(F.col("doc_id").alias("key"), F.col("_digest").alias("digest"), "text"), SHINGLE_WORDS, LEAST_SIMILARITY)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("digest").alias("digest"))).alias("_first")
    keep = materialise(grouped.groupBy("group").agg(first).select(F.col("_first.key").alias("_keep"), F.col("_first.digest").alias("_of")), "pipeline-kept")
    kept = docs.join(keep, (F.col("_digest") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_keep")), "left_semi")
    # rows of one doc_id and one text are copies of each other
    return kept.dropDuplicates(["doc_id", "_digest"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand anywhere else too are cut from every document, at whole characters. Null texts stay null and empty
    ones empty; repeated rows, having all their bytes elsewhere, become empty if they are long enough. A very long text is
    cut whole."""
    docs = documents_of(docs)
    rows, cut = remove_repeats(docs, PASSAGE_BYTES, PASSAGE_GRAM, characters=True)
    keyed = docs.withColumn("_key", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
    joined = keyed.join(cut.select("of", "kept"), F.col("_key") == F.col("of"), "left")
    text = F.when(F.col("of").isNull(), F.col("text")).otherwise(F.col("kept").cast("string"))
    return joined.withColumn("text", text).withColumn("n_chars", F.when(F.col("of").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: null and empty texts have no words and stay or go with the whole copies of
    their source; a null source is a source of its own. Rows that agree in doc_id, source and number of words are taken alike, those without a
    doc_id if their texts agree too. A very long text is taken whole or not at all. Nothing comes from an empty table."""
    tell = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    sized = documents_of(docs).withColumns({"size": word_count(F.col("text")), "_tell": tell})
    taken = mix_sources(sized.select("doc_id", "source", "size", F.col("_tell").alias("tell")), tell="tell").where("copies > 0")
    copies = materialise(taken.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("tell").alias("_told"), "copies"), "pipeline-copies")
    # a doc_id that repeats has one row for each repeat here: alike rows are taken alike
    copies = copies.groupBy("_id", "_source", "_size", "_told").agg(F.max("copies").alias("copies"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")) & F.col("_tell").eqNullSafe(F.col("_told"))
    return sized.join(copies, on).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens. Null and empty texts are one end token; a very long text is cut into whole sequences and a tail;
    repeated rows are packed one by one."""
    return pack_documents(docs, default_tokenizer(), ["doc_id"])


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_passages", cut_repeats), ("mixing", mix), ("packing", pack)]

#: The classifier and the fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
