"""Streams over many files, held against batch results."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from tempora.streaming import streams

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "event_id long, user_id long, event_type string, value double, ts timestamp"


def write(spark, folder, files):
    """One Parquet file for each list of events, so that one batch reads one."""
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{i:03d}")
    for i in range(len(files)):
        (part,) = (folder / f"{i:03d}").glob("*.parquet")
        part.rename(folder / f"events-{i:03d}.parquet")
    import os
    for i in range(len(files)):  # files are read in order of their time of change
        os.utime(folder / f"events-{i:03d}.parquet", (1_700_000_000 + i * 10,) * 2)


def greedy(events, gap):
    kept, last = set(), {}
    for _, user, _, _, at in sorted(events, key=lambda e: (e[4], e[0])):
        if user not in last or (at - last[user]).total_seconds() >= gap:
            last[user] = at
            kept.add((user, at))
    return kept


@pytest.mark.parametrize("order", ["sorted", "shuffled"])
def test_cooldown_over_files_out_of_order(spark, tmp_path, order):
    rng = random.Random(3)
    events = [(i, rng.randrange(5), "view", 1.0, START + timedelta(seconds=rng.randrange(40_000), microseconds=rng.randrange(1_000_000))) for i in range(300)]
    events.sort(key=lambda e: e[4])
    if order == "shuffled":  # by less than the hour that the watermark waits
        events.sort(key=lambda e: e[4] + timedelta(seconds=rng.randrange(-1500, 1500)))
    files = [events[i : i + 25] for i in range(0, len(events), 25)]
    end = START + timedelta(days=3)
    files.append([(1000, 99, "end", 0.0, end)])
    files.append([(1001, 99, "end", 0.0, end + timedelta(days=3))])
    write(spark, tmp_path, files)
    stream = streams.event_stream(spark, f"{tmp_path}/events-*.parquet")
    progress = []
    found = streams.run(streams.cooldown(stream, 900.0), progress=progress).collect()
    assert {(r.user_id, r.ts.replace(tzinfo=timezone.utc)) for r in found if r.user_id != 99} == greedy(events, 900.0)
    assert len({r.event_id for r in found}) == len(found)
    assert progress[0].stateOperators[0].numRowsTotal == 1  # the last event waits; every other key's state is cleared


def test_events_behind_the_watermark_are_dropped(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    write(spark, tmp_path, [[(1, 1, "a", 0.0, at(0))], [(2, 1, "a", 0.0, at(10))], [(3, 1, "a", 0.0, at(4)), (4, 1, "a", 0.0, at(9.5))], [(5, 2, "a", 0.0, at(40))]])
    found = streams.run(streams.cooldown(streams.event_stream(spark, f"{tmp_path}/events-*.parquet"), 60.0)).collect()
    assert sorted(r.event_id for r in found) == [1, 2, 4]


def test_sliding_windows(spark, tmp_path):
    rows = [(i, 1, "a" if i % 2 else "b", 1.0, START + timedelta(minutes=10 * i)) for i in range(40)]
    write(spark, tmp_path, [rows[:20], rows[20:], [(99, 1, "z", 0.0, START + timedelta(days=2))]])
    found = streams.run(streams.sliding(streams.event_stream(spark, f"{tmp_path}/events-*.parquet"), "1 hour", "30 minutes", "10 minutes")).collect()
    want = {}
    for _, _, kind, _, at in rows:
        for k in range(-2, 90):
            start = START + timedelta(minutes=30 * k)
            if start <= at < start + timedelta(hours=1):
                want[start, kind] = want.get((start, kind), 0) + 1
    assert {(r.start_ts.replace(tzinfo=timezone.utc), r.event_type): r.n for r in found if r.event_type != "z"} == want
