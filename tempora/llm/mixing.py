"""Mixing sources to target weights by Pareto order sampling (native).

Each source gets a target number of words: a share of a budget by weight, at most ``max_repeat``
times the source's own size, what is above being shared again among the others. Within a source longer
documents are likelier: a document whose size has b binary digits has the weight ``BASE_WEIGHT`` + b, and is
expected level * weight times, at most ``max_repeat`` times, where the source's level is such that the
expected words add up to its target. The whole part of that is certain: so many whole copies of the
document are taken. The fractional part is an inclusion probability p; the
documents are ranked by their random odds u/(1-u) over their inclusion odds p/(1-p), u being a
hash of the document, and taken in this order until the words that are left are used up. The
document at which the line is crossed is taken if that brings the source nearer to its target.

Levels come from sums by source and number of digits, some thirty rows a source.
The order is found without gathering a source in one task: a histogram over buckets of the
ranking variable is summed by window, and only the documents of the one bucket of each source in
which the line is crossed are put in order. Bucket, sum and order use all documents.

Defined cases: null text has size 0; size 0 takes 0; a null source is a source of its own, the
last; repeated rows share u and are ordered arbitrarily among themselves, being alike; rows without a doc_id are told apart by the
column ``tell``, where one is named. Columns that are named like one of the result are left out. Reruns
agree. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, need_columns

WEIGHTS = (3, 1, 2)
#: The budget as a fraction of all words, and the most copies of one document.
SHARE, MAX_REPEAT = 1.5, 2
#: What a document's weight is above the number of binary digits of its size.
BASE_WEIGHT = 8
SEED = "mix-1"
#: Buckets of the ranking variable in each source.
BUCKETS = 65_536
#: Source tables up to this many rows are broadcast (some 60 bytes each).
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_uniform(doc_id: Column, seed: str = SEED, tell: Column | None = None) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the document's id, or where that is null of ``tell``."""
    nameless = F.lit("null") if tell is None else F.concat(F.lit("null:"), F.coalesce(tell.cast("string"), F.lit("")))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), nameless)).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**52))


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sources (source, source_size) with target. Sources are ranked in code point order, null
    last, over range partitions: a rank within each partition plus the partitions' offsets."""
    spark = sources.sparkSession
    ranged = materialise(
        sources.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()), "mix-sources"
    )
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select(F.col("_part").alias("_of"), (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    cycle = F.array(*[F.lit(w) for w in weights])
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last()))
    ranked = (
        ranged.withColumn("_within", within)
        .join(F.broadcast(offsets), F.col("_part") == F.col("_of"))
        .withColumn("_weight", F.element_at(cycle, ((F.col("_offset") + F.col("_within") - 1) % len(weights) + 1).cast("int")).cast("long"))
        .select("source", "source_size", "_weight", (F.col("source_size") * max_repeat).alias("_most"))
    )
    ranked = materialise(ranked, "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget = share * total
    level, seen = 0.0, -1
    while True:  # each round caps at least one more source, and only sums come to the driver
        capped = F.col("_most") < F.col("_weight") * F.lit(level) if seen >= 0 else F.lit(False)
        row = ranked.agg(
            F.coalesce(F.sum(F.when(capped, F.col("_most"))), F.lit(0)).alias("used"), F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0)).alias("open"), F.count(F.when(capped, 1)).alias("n")
        ).first()
        if row.n == seen or not row.open:
            break
        seen, level = row.n, (budget - row.used) / row.open
    used, open_weight = float(budget - row.used), row.open
    target = F.when(F.col("_most") < F.col("_weight") * F.lit(level), F.col("_most").cast("double")).otherwise(
        F.least(F.col("_most").cast("double"), F.col("_weight") * F.lit(used) / F.lit(float(open_weight or 1)))
    )
    return ranked.select("source", "source_size", target.alias("target"))


def document_chances(sums: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sums (source, digits, size: words of the source's documents of so many digits; source_size, target) with
    whole, the certain copies of such a document, p, the chance of one more, and left, the words of the source's
    target that its certain copies leave. Classes are capped from the heaviest down, until the level that serves
    the others caps none of them."""
    down = Window.partitionBy("source").orderBy(F.desc("digits"))
    weight = (F.col("digits") + BASE_WEIGHT).cast("long")
    before = F.coalesce(F.sum("size").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(weight * F.col("size")).over(down.rowsBetween(0, Window.unboundedFollowing))
    level = F.when(rest > 0, (F.col("target") - max_repeat * before) / rest)
    fits = F.when(level * weight <= max_repeat, level)
    found = sums.withColumn("_level", fits).withColumn("_level", F.first("_level", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    expected = F.greatest(F.least(F.coalesce(F.col("_level") * weight, F.lit(float(max_repeat))), F.lit(float(max_repeat))), F.lit(0.0))
    expected = F.when(F.col("source_size") > 0, expected).otherwise(0.0)
    chances = found.withColumn("_expected", expected).withColumn("whole", F.floor("_expected").cast("long")).withColumn("p", F.col("_expected") - F.col("whole"))
    everyone = Window.partitionBy("source")
    return chances.withColumn("left", F.col("target") - F.sum(F.col("whole") * F.col("size")).over(everyone)).drop("_level", "_expected")


OUT = ["doc_id", "source", "size", "source_size", "target", "copies"]


def mix_sources(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT, seed: str = SEED, buckets: int = BUCKETS, tell: str | None = None) -> DataFrame:
    """sized has doc_id, source, size and may have more columns: each row with source_size, target and copies, how
    often the mix takes it."""
    extra = [c for c in sized.columns if c not in OUT]
    named = sized.select(
        "doc_id", "source", "size", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in extra]).alias("_kept"), document_uniform(F.col("doc_id"), seed, F.col(f"`{tell}`") if tell else None).alias("_u"), F.length(F.bin("size")).alias("_digits")
    )
    classes = materialise(named.groupBy("source", F.col("_digits").alias("digits")).agg(F.sum("size").alias("size")), "mix-classes")
    targets = source_targets(classes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeat)
    per = targets.select(F.col("source").alias("_source"), "source_size", "target")
    sums = classes.join(per, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    chances = materialise(document_chances(sums, max_repeat), "mix-chances")
    few = chances.count() <= BROADCAST_SOURCES
    per = chances.select(F.col("source").alias("_source"), F.col("digits").alias("_of"), "source_size", "target", F.col("whole").alias("_whole"), F.col("p").alias("_p"), F.col("left").alias("_left"))
    per = F.broadcast(per) if few else per
    odds = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p")))
    keyed = (
        named.join(per, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_digits") == F.col("_of")), "left")
        .drop("_source", "_of", "_digits")
        .withColumn("_q", F.when((F.col("_p") > 0) & (F.col("size") > 0), odds))
        .withColumn("_bucket", F.when(F.col("_q").isNotNull(), F.least(F.floor(F.col("_q") / (1 + F.col("_q")) * buckets), F.lit(buckets - 1)).cast("int")))
    )
    # where each source's line falls: the last bucket that starts before what is left is used up
    hist = keyed.where("_bucket is not null").groupBy("source", "_bucket").agg(F.sum("size").alias("_in"), F.first("_left").alias("_left"))
    before = F.sum("_in").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_in")
    lines = hist.withColumn("_before", before).where("_before <= _left and _left < _before + _in").select(F.col("source").alias("_line_source"), F.col("_bucket").alias("_line"), "_before")
    lines = materialise(lines, "mix-lines")
    if few:
        lines = F.broadcast(lines)  # one row a source at most
    placed = keyed.join(lines, F.col("source").eqNullSafe(F.col("_line_source")), "left").drop("_line_source")
    # documents outside the line's bucket are decided; those in it are put in order
    out = placed.where("_bucket is null or _line is null or _bucket <> _line").withColumn(
        "copies", F.col("_whole") + F.when(F.col("_bucket").isNotNull() & (F.col("_line").isNull() | (F.col("_bucket") < F.col("_line"))), 1).otherwise(0)
    )
    order = Window.partitionBy("source").orderBy("_q", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.where("_bucket = _line").withColumn("_end", F.col("_before") + F.sum("size").over(order))
    inside = inside.withColumn("copies", F.col("_whole") + F.when(F.col("_end") - F.col("_left") < F.col("_left") - (F.col("_end") - F.col("size")), 1).otherwise(0))
    chosen = ["doc_id", "source", "size", *[F.col(f"_kept.`{c}`").alias(c) for c in extra], "source_size", "target", "copies"]
    return out.select(chosen).unionByName(inside.select(chosen))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = need_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "source", "text")
    tell = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    sized = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), tell.alias("tell")), "mix-sized")
    return mix_sources(sized, tell="tell").select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), sorted AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()::BIGINT AS budget,
    coalesce(sum(2 * source_size) OVER before, 0)::BIGINT AS used_before, sum(weight) OVER from_here AS open_weight
  FROM sources
  WINDOW before AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         from_here AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), capping AS (
  SELECT *, 2 * source_size < weight * ((budget - used_before) / open_weight::DOUBLE) AS capped FROM sorted
), totals AS (
  SELECT max(budget) - coalesce(sum(CASE WHEN capped THEN 2 * source_size END), 0)::DOUBLE AS free, sum(CASE WHEN NOT capped THEN weight END)::DOUBLE AS weights FROM capping
), targets AS (
  SELECT source, source_size, CASE WHEN capped THEN (2 * source_size)::DOUBLE ELSE least((2 * source_size)::DOUBLE, weight * free / weights) END AS target
  FROM capping, totals
), classes AS (
  SELECT s.source, length(bin(size)) AS digits, sum(size)::BIGINT AS words, 8 + length(bin(size)) AS weight FROM sized s GROUP BY ALL
), levels AS (
  SELECT c.*, t.source_size, t.target, (t.target - 2 * coalesce(sum(words) OVER above, 0)::BIGINT) / nullif(sum(weight * words) OVER from_here, 0)::BIGINT::DOUBLE AS level
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW above AS (PARTITION BY c.source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), from_here AS (PARTITION BY c.source ORDER BY digits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), fitting AS (
  SELECT *, max_by(level, digits) FILTER (level * weight <= 2) OVER (PARTITION BY source) AS fit FROM levels
), expected AS (
  SELECT *, greatest(least(coalesce(fit * weight, 2.0::DOUBLE), 2.0::DOUBLE), 0.0::DOUBLE) AS e FROM fitting
), chances AS (
  SELECT source, digits, source_size, target, floor(e)::BIGINT AS whole, e - floor(e) AS p, target - sum(floor(e)::BIGINT * words) OVER (PARTITION BY source)::BIGINT AS words_left FROM expected
), ranked AS (
  SELECT s.*, c.source_size, c.target, c.whole, c.words_left, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q
  FROM sized s JOIN chances c ON s.source IS NOT DISTINCT FROM c.source AND length(bin(s.size)) = c.digits
), ended AS (
  SELECT *, sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS ends
  FROM ranked
)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN q IS NOT NULL AND (ends <= words_left OR (ends - size <= words_left AND ends - words_left < words_left - (ends - size))) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM ended
"""
