"""Queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

HOUR = 3_600_000_000

#: The timeline proxy in SQL, for the oracles.
TL = """tl AS (
  SELECT *, (idx - 1) // 4 + 1 AS bar, (idx - 1) % 4 + 1 AS beat_in_bar, lead(t) OVER (PARTITION BY entity_id ORDER BY idx) AS next_t,
         lag(energy) OVER (PARTITION BY entity_id ORDER BY idx) AS before
  FROM (
    SELECT user_id AS entity_id, event_id, epoch_us(ts) AS t, event_type AS label, CAST(round(value * 100) AS BIGINT) AS energy,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idx
    FROM events)
)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; integers come out as long, as in the oracle."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast("long") for c, kind in df.dtypes if kind in ("int", "smallint", "tinyint")})

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return f

    return register
