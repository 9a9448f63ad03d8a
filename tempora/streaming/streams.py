"""Windows, sessions, cooldowns and duplicate suppression over event streams.

Each function takes and returns a streaming DataFrame with an event time ``ts`` (TIMESTAMP); run()
drives one to its end over the files there are (availableNow) and returns what was emitted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.tables import artifact_dir


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of events as a stream; ts as TIMESTAMP, which watermarks need."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", name).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str, late: str, by: str = "event_type") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), by).agg(F.count("*").alias("n"), F.max("value").alias("max_value")).select(F.col("window.start").alias("start_ts"), by, "n", "max_value")


def sliding(events: DataFrame, width: str, step: str, late: str, by: str = "event_type") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, step), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start_ts"), by, "n")


def sessions(events: DataFrame, gap: str, late: str, by: str = "user_id") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), by).agg(F.count("*").alias("n")).select(by, F.col("s.start").alias("start_ts"), F.col("s.end").alias("end_ts"), "n")


def distinct_events(events: DataFrame, late: str, key: str = "event_id") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def _milli_up(us: int) -> int:
    return -(-us // 1000)


def cooldown(events: DataFrame, gap_s: float, late: str = "1 hour", by: str = "user_id") -> DataFrame:
    """Events kept greedily in order of time: each at least gap_s after the last kept of its key. Events may come in any
    order within the watermark: each waits in its key's state until the watermark is past it, by a timer where no other event
    of the key comes, and then its turn comes in order of time and event_id. Events behind the watermark are dropped. A key's state is the events that wait and
    one time; once nothing waits and the time is a gap behind the watermark, a timer clears it."""
    gap = round(gap_s * 1_000_000)

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, waiting = None, []
        if state.exists:
            last, times, ids = state.get
            waiting = list(zip(map(int, times), map(int, ids)))
        passed = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            for pdf in batches:
                waiting += [(at, event) for at, event in zip(pdf["us"].tolist(), pdf["event_id"].tolist()) if _milli_up(at) >= passed]
        due = sorted(e for e in waiting if _milli_up(e[0]) < passed)
        waiting = [e for e in waiting if _milli_up(e[0]) >= passed]
        out = []
        for at, event in due:
            if last is None or at - last >= gap:
                last = at
                out.append((key[0], event, at))
        if waiting or (last is not None and _milli_up(last + gap) >= passed):
            state.update((last, [at for at, _ in waiting], [event for _, event in waiting]))
            state.setTimeoutTimestamp(max(passed + 1, min(_milli_up(at) for at, _ in waiting) if waiting else _milli_up(last + gap)))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=[by, "event_id", "us"])

    timed = events.withWatermark("ts", late).select(by, "event_id", "ts", F.unix_micros("ts").alias("us"))
    kept = timed.groupBy(by).applyInPandasWithState(keep, f"{by} long, event_id long, us long", "last long, times array<long>, ids array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return kept.select(by, "event_id", F.timestamp_micros("us").alias("ts"))


def run(stream: DataFrame, mode: str = "append", progress: list | None = None) -> DataFrame:
    """Everything a stream emits over the files there are, as a table written batch by batch. Its
    state and output lie in the folder that all executors share. ``progress`` gets the last batch's."""
    spark = stream.sparkSession
    place = f"{artifact_dir(spark)}/stream-{uuid.uuid4().hex}"
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{place}/state").option("path", f"{place}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    if progress is not None:
        progress.append(query.lastProgress)
    return spark.read.schema(stream.schema).parquet(f"{place}/out")
