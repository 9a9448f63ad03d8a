"""URL filters by hashed host-suffix and path-prefix expressions (native).

Every URL is expanded into expressions, each a host suffix at a label boundary followed by a path
prefix that ends at a slash. Expressions and rules meet in an equi-join on a short prefix of
their SHA-256 digests; a survivor is confirmed by the full digest, and the longest rule wins.

Everything runs in DataFrame functions. Nothing is collected but two bounds of the rule table:
the most labels and the most slashes of any rule, beyond which an expression can match nothing.

Defined cases: a null URL or one without ``://`` has an empty host and an empty path and matches
no rule; it gets the default verdict. A path that is empty does not start with ``/``. Rules of
equal length are ordered by the longer host, then by rule string, a block before an allow.
Repeated rows are judged one by one; columns beyond the two used are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, need_columns

#: Hexadecimal digits of the digest that the join compares.
PREFIX_DIGITS = 8
#: Rules up to this number are broadcast (about 200 bytes each); more are joined by a shuffle.
BROADCAST_RULES = 50_000
#: In the shuffled join each rule is repeated this often, so that a hot expression spreads.
SALTS = 16

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
RULE_SCHEMA = "rule_host string, rule_path string, verdict string"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules with the key under which URLs look them up: the path is cut after its last slash."""
    host = lower_ascii(F.col("rule_host"))
    key_path = F.regexp_extract("rule_path", r"(?s)^(.*/)?", 0)
    return (
        rules.where("rule_host is not null and rule_path is not null")
        .select(host.alias("rule_host"), "rule_path", "verdict")
        .distinct()
        .select(
            "*",
            F.concat("rule_host", "rule_path").alias("rule"),
            F.substring(F.sha2(F.concat(F.col("rule_host"), F.lit("\n"), key_path), 256), 1, PREFIX_DIGITS).alias("prefix"),
            F.sha2(F.concat(F.col("rule_host"), F.lit("\n"), F.col("rule_path")), 256).alias("digest"),
        )
    )


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Structs (suffix, key_path) of a URL: host suffixes of up to ``labels`` labels by path
    prefixes of up to ``slashes`` slashes, the empty prefix included."""
    parts = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    steps = F.split(path, "/", slashes + 1)
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size(steps) - 1),
        lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/"))),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(s.alias("suffix"), p.alias("key_path")))))


OUT = ["host", "path", "rule", "verdict"]


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """pages with host, path, rule (null where none fits) and verdict; one row for each input row. Columns of pages that have
    these names are left out.
    """
    kept = [c for c in pages.columns if c != url and c not in OUT]
    held = pages.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("_kept"), F.col(f"`{url}`").alias("_url"))
    columns = [F.col("_url").alias(c) if c == url else F.col(f"_kept.`{c}`").alias(c) for c in pages.columns if c not in OUT]
    ready = prepare_rules(rules)
    bounds = ready.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
        F.max(F.size(F.split("rule_path", "/", -1)) - 1).alias("slashes"),
    ).first()
    judged = held.withColumns({"host": url_host(F.col("_url")), "path": url_path(F.col("_url"))})
    if not bounds.n:
        return judged.select(*columns, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    keyed = judged.withColumn("_row", F.monotonically_increasing_id())
    wide = keyed.withColumn("_e", F.explode(expressions(F.col("host"), F.col("path"), bounds.labels, bounds.slashes))).withColumn(
        "_prefix", F.substring(F.sha2(F.concat("_e.suffix", F.lit("\n"), "_e.key_path"), 256), 1, PREFIX_DIGITS)
    )
    right = ready.select(*[F.col(c).alias(f"_{c}") for c in ("rule_host", "rule_path", "verdict", "rule", "prefix", "digest")]).withColumnRenamed("_prefix", "_rule_prefix")
    on = F.col("_prefix") == F.col("_rule_prefix")
    if bounds.n <= broadcast_rules:
        right = F.broadcast(right)
    else:
        wide = wide.withColumn("_salt", F.pmod("_row", F.lit(SALTS)))
        right = right.withColumn("_rule_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on &= F.col("_salt") == F.col("_rule_salt")
    confirmed = F.sha2(F.concat(F.col("_e.suffix"), F.lit("\n"), F.substring(F.col("path"), F.lit(1), F.length("_rule_path"))), 256) == F.col("_digest")
    best = F.max(
        F.when(
            confirmed,
            F.struct(F.length("_rule").alias("length"), F.length("_rule_host").alias("host_length"), F.col("_rule").alias("rule"), (F.col("_verdict") == "block").alias("blocks"), F.col("_verdict").alias("verdict")),
        )
    ).alias("_best")
    return (
        wide.join(right, on, "left")
        .groupBy("_row")
        .agg(*[F.first(c).alias(c) for c in judged.columns], best)
        .select(*columns, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = need_columns(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url")
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged AS (
  SELECT page_id, host, path,
    (SELECT max_by({'rule': rule_host || rule_path, 'verdict': r.verdict}, length(rule_host || rule_path)) FROM rules r
     WHERE (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)) AS best
  FROM parts
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""
