"""Semantics of the timeline operators on hand-written rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tempora.functions import scalars
from tempora.operators import features, grid, joins, layers, rules, sequences, validation, windows
from tempora.plans import QUERIES, SQL
from tempora.sources import tables

SF = "/root/testdata/sf0.001"
E = "entity_id"


def points(spark, times, entity=1, **more):
    rows = [(entity, i, t, *[v[i] for v in more.values()]) for i, t in enumerate(times)]
    kinds = ", ".join(f"{k} {'string' if isinstance(v[0], str) else 'long'}" for k, v in more.items())
    return spark.createDataFrame(rows, "entity_id long, event_id long, t long" + (", " + kinds if kinds else ""))


def spans(spark, pairs, entity=1):
    return spark.createDataFrame([(entity, i, a, b) for i, (a, b) in enumerate(pairs)], "entity_id long, section long, start_t long, end_t long")


def test_containment_and_fallback(spark):
    sections = spans(spark, [(10, 20), (30, 40)])
    asked = points(spark, [5, 10, 20, 25, 39, 40, 99])
    got = {r.t: r.inside for r in joins.containing(asked, sections).collect()}
    assert {t: x and x.section for t, x in got.items()} == {5: None, 10: 0, 20: None, 25: None, 39: 1, 40: None, 99: None}
    got = {r.t: r.inside for r in joins.containing(asked, sections, fallback_last=True).collect()}
    assert {t: x and x.section for t, x in got.items()} == {5: None, 10: 0, 20: None, 25: None, 39: 1, 40: 1, 99: 1}


def test_nearest_ties_and_tolerance(spark):
    beats = points(spark, [0, 10, 20]).withColumnRenamed("event_id", "beat")
    asked = points(spark, [5, 14, 26, -3])
    early = {r.t: (r.near and r.near.beat, r.delta) for r in joins.nearest(asked, beats, tolerance=5).collect()}
    assert early == {5: (0, 5), 14: (1, 4), 26: (None, 6), -3: (0, -3)}
    assert {r.t: r.near.beat for r in joins.nearest(asked, beats, later=True).collect()} == {5: 1, 14: 1, 26: 2, -3: 0}


def test_overlaps_are_strict_and_made_once(spark):
    a = spark.createDataFrame([(1, 1, 0, 100, 7)], "entity_id long, a_id long, a_start long, a_end long, a_label long")
    b = spark.createDataFrame([(1, 1, 100, 150, 7), (1, 2, 20, 90, 8), (1, 3, 90, 95, 7), (2, 4, 0, 50, 7)], "entity_id long, b_id long, b_start long, b_end long, b_label long")
    assert sorted((r.b_id, r.shared) for r in joins.overlapping(a, b, 10).collect()) == [(2, 70), (3, 5)]
    assert joins.best_overlap(a, b, 10).first().result == "differs"
    assert joins.coverage(a, b, 10).first().score == 0.75
    assert joins.first_overlap(a, b, 10).first().b_id == 2


def test_range_join_takes_every_interval(spark):
    rows = points(spark, [0, 5, 10, 15])
    got = joins.in_range(rows, spans(spark, [(0, 10), (5, 16), (20, 20)]).drop("event_id"), 4).collect()
    assert sorted((r.t, r.section) for r in got) == [(0, 0), (5, 0), (5, 1), (10, 1), (15, 1)]
    closed = joins.in_range(rows, spans(spark, [(0, 10)]), 4, closed=True).collect()
    assert sorted(r.t for r in closed) == [0, 5, 10]


def test_greedy_matching(spark):
    kind = "entity_id long, id long, type string, start_t long, end_t long"
    expected = spark.createDataFrame([(1, 1, "drop", 10, 20), (1, 2, "drop", 12, 22), (1, 3, "build", 50, 60)], kind)
    actual = spark.createDataFrame([(1, 7, "drop", 11, 21), (1, 8, "build", 90, 95), (2, 9, "drop", 1, 2)], kind)
    got = {(r.entity_id, r.expected_id, r.actual_id) for r in joins.greedy_matches(expected, actual, 5).collect()}
    assert got == {(1, 1, 7), (1, 2, None), (1, 3, None), (1, None, 8), (2, None, 9)}


def test_boundaries_walk(spark):
    got = joins.match_boundaries(points(spark, [0, 10, 20, 40]), points(spark, [1, 11, 30, 41, 60]), 2).collect()
    assert [(r.result, r.reference_t, r.inferred_t) for r in got] == [("match", 10, 11), ("missed", 20, None), ("extra", None, 30), ("match", 40, 41), ("extra", None, 60)]


def test_bars_and_blocks(spark):
    beats = grid.beats(points(spark, [0, 10, 20, 30, 40, 52]))
    assert [(r.bar, r.start_t, r.end_t) for r in grid.bars(beats).orderBy("bar").collect()] == [(1, 0, 40.0), (2, 40, 62.0)]
    rows = points(spark, list(range(10)), x=[1] * 10)
    assert [(r.block, r.n_rows) for r in grid.blocks(rows, 4, ["x"], least=3).orderBy("block").collect()] == [(0, 4), (1, 6)]
    got = grid.sliding(rows, 4, 3, aligned_last=True).groupBy("window_start").count().orderBy("window_start").collect()
    assert [(r.window_start, r["count"]) for r in got] == [(0, 4), (3, 4), (6, 4)]


def test_resample_takes_the_earlier_on_a_tie(spark):
    got = grid.resample(points(spark, [0, 10, 20], x=[1, 2, 3]), 5, ["x"]).orderBy("grid_t").collect()
    assert [r.x for r in got] == [1, 1, 2, 2, 3]


def test_cooldown_is_greedy(spark):
    rows = points(spark, [0, 5, 8, 10, 17])
    assert [r.t for r in sequences.cooldown(rows, 8).orderBy("t").collect()] == [0, 8, 17]
    assert [r.t for r in sequences.cooldown(rows, 8, strict=True).orderBy("t").collect()] == [0, 10]


def labelled(spark, labels, **more):
    rows = points(spark, [10 * i for i in range(len(labels))], label=list(labels), **more)
    return rows.withColumn("idx", F.col("event_id").cast("int") + 1)


def test_runs_and_short_runs(spark):
    rows = labelled(spark, "aabbbbcaaaa", energy=[1] * 11)
    got = sequences.runs(rows).orderBy("run").collect()
    assert [(r.label, r.n_rows, r.start_t, r.end_t) for r in got] == [("a", 2, 0, 20), ("b", 4, 20, 60), ("c", 1, 60, 70), ("a", 4, 70, 100)]
    assert "".join(r.label for r in sequences.absorb_short_runs(rows).orderBy("idx").collect()) == "bbbbbbbaaaa"
    assert "".join(r.label for r in sequences.viterbi(labelled(spark, "aaabaaabbb", energy=[1] * 10), ["a", "b"], stay=0.99, emit=0.9).orderBy("idx").collect()) == "aaaaaaabbb"


def test_patterns(spark):
    phrase = ["CCCC", "GGGG", "AAAA", "FFFF"]
    bars = spark.createDataFrame([(1, i + 1, list(phrase[i % 4])) for i in range(24)], "entity_id long, bar int, beats array<string>")
    got = sequences.mine_patterns(bars).collect()
    assert {(r.start_bar, r.end_bar) for r in got if r.pattern == 1} and all(r.mismatches == 0 for r in got)
    covered = sorted(b for r in got for b in range(r.start_bar, r.end_bar + 1))
    assert len(covered) == len(set(covered)) == 24
    units = spark.createDataFrame([(list("abab"),), (list("aaaa"),), (list("abca"),)], "l array<string>").select(sequences.repeating_unit(F.col("l")).alias("u")).collect()
    assert [r.u for r in units] == [2, 1, 4]
    assert spark.range(1).select(sequences.mismatches(F.lit(["a", "b"]), F.lit(["a", "c"])).alias("m")).first().m == 1


def test_pairwise_left_fold(spark):
    rows = spark.createDataFrame([(1, "a", 0, 1, 1.0), (1, "a", 1, 2, 3.0), (1, "a", 2, 3, 6.0), (1, "b", 3, 4, 5.0)], "entity_id long, label string, start_t long, end_t long, confidence double")
    assert [(r.label, r.end_t, r.confidence) for r in sequences.merge_equal(rows).orderBy("start_t").collect()] == [("a", 3, 4.0), ("b", 4, 5.0)]


def test_notes_and_prototypes(spark):
    notes = spark.createDataFrame([(1, 1, 0, 60, 1, 5), (1, 2, 3, 61, 0, 1), (1, 3, 50, 60, 0, 2), (1, 4, 51, 60, 0, 9)], "entity_id long, event_id long, t long, pitch long, priority int, confidence long")
    assert [r.event_id for r in sequences.distinct_notes(notes, 5).orderBy("t").collect()] == [2, 4]
    vectors = spark.createDataFrame([(1, 1, [1.0, 0.0]), (1, 2, [0.0, 1.0]), (1, 3, [2.0, 0.01])], "entity_id long, idx int, vector array<double>")
    assert [r.grp for r in sequences.prototypes(vectors).orderBy("idx").collect()] == [1, 2, 1]


def test_flat_columns(spark):
    rows = labelled(spark, "aaa", energy=[4, 4, 4])
    stats = features.statistics(rows, "energy")
    assert stats.first().deviation == 0.0
    joined = rows.join(stats, E).select(scalars.z_score(F.col("energy"), F.col("mean"), F.col("deviation")).alias("z"), scalars.min_max(F.col("energy"), E).alias("m"))
    assert {(r.z, r.m) for r in joined.collect()} == {(0.0, 0.0)}


def test_override_lists_end_at_delete(spark):
    events = spark.createDataFrame([(1, 0, 9, "drop"), (2, 0, 9, "drop"), (3, 0, 9, "drop")], "event_id long, start_t long, end_t long, type string")
    ops = spark.createDataFrame([(1, 1, "retime", 2, 3, None, None), (1, 2, "relabel", None, None, "build", None), (1, 3, "annotate", None, None, None, "n"), (2, 1, "delete", None, None, None, None), (2, 2, "confirm", None, None, None, None)], "event_id long, seq int, action string, start_t long, end_t long, type string, note string")
    got = {r.event_id: (r.start_t, r.end_t, r.type, r.note, r.status) for r in rules.apply_overrides(events, ops).collect()}
    assert got == {1: (2, 3, "build", "n", "annotate"), 3: (0, 9, "drop", None, "generated")}


def test_contract(spark):
    rows = spark.createDataFrame([(1, " Build-Up ", 0, 1, 0.5, None), (2, "pause", 5, 4, 1.5, 2.0), (3, None, 0, 0, None, 0.5)], "event_id long, type string, start_t long, end_t long, confidence double, intensity double")
    got = sorted((r.event_id, r.violation) for r in validation.violations(rows, validation.event_rules()).collect())
    assert got == [(1, "type"), (2, "confidence"), (2, "intensity"), (2, "time_order"), (3, "confidence"), (3, "type")]


def test_union_keeps_the_earlier_list(spark):
    one, two = (points(spark, [1, 2], type=["a", "b"]).withColumn("event_id", F.col("event_id") + k) for k in (0, 10))
    assert sorted(r.event_id for r in layers.refined_union([two, one], [E, "t", "type"]).collect()) == [10, 11]


def test_json_round_trip_and_missing_source(spark, tmp_path):
    rows = points(spark, [1, 2]).withColumn("x", F.lit(1.23456789))
    tables.write_json(rows, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert {r.x for r in back.collect()} == {1.234568}
    assert tables.read_json_rows(spark, str(tmp_path / "none"), tables.HINTS).count() == 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in/A Song.json").write_text('[{"id": "h", "title": "t", "start_time": 1.0}]')
    assert [(r.entity_id, r.id) for r in tables.read_json_rows(spark, str(tmp_path / "in"), tables.HINTS).collect()] == [("A Song", "h")]
    (tmp_path / "in/x.MP3").write_bytes(b"123")
    assert [(r.entity_id, r.length) for r in tables.discover(spark, str(tmp_path / "in"), "mp3").collect()] == [("x", 3)]


def test_vectors_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    rows = {i: np.array(v, dtype=float) for i, v in zip(table.vec_id, table.embedding)}
    first = rows[min(rows)]
    for r in QUERIES["cosine_to_first"](spark, SF).collect():
        assert abs(r.cosine - rows[r.vec_id] @ first / np.linalg.norm(rows[r.vec_id]) / np.linalg.norm(first)) < 1e-9
    for r in QUERIES["band_sums"](spark, SF).collect():
        assert abs(r.total - rows[r.vec_id][9 * r.band : 9 * r.band + 9 if r.band < 6 else 64].sum()) < 1e-9
    label = dict(zip(table.vec_id, table.label))
    for r in QUERIES["closest_in_group"](spark, SF).collect():
        others = [rows[r.vec_id] @ v for i, v in rows.items() if i != r.vec_id and label[i] == label[r.vec_id]]
        assert not others or abs(r.score - max(others)) < 1e-9


def test_closest_in_group_by_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 3 if i % 3 < 2 else None, i, [float(x) for x in rng.normal(size=6)]) for i in range(90)]
    rows += [(0, 200, rows[0][2]), (0, 200, rows[0][2]), (1, 201, rows[1][2]), (9, 300, [1.0] * 6)]
    table = spark.createDataFrame(rows, "label int, vec_id long, embedding array<double>")
    want = []  # scores to nine places
    for i, (by, key, vector) in enumerate(rows):
        others = [(-sum(a * b for a, b in zip(v, vector)), k) for j, (g, k, v) in enumerate(rows) if j != i and g == by]
        score, other = min(others) if others else (None, -1)
        want.append((by, key, other, None if score is None else round(-score, 9)))
    for size in (7, 1000):
        got = [(r.label, r.vec_id, r.other, None if r.score != r.score else round(r.score, 9)) for r in features.closest_in_group(table, "label", "vec_id", "embedding", size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def plain(rows):
    return sorted((tuple(None if isinstance(v, float) and v != v else v for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    found = con.execute(SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in sorted(columns)]
    assert plain(tuple(r) for r in df.select(*sorted(df.columns)).collect()) == plain(tuple(r[i] for i in order) for r in found.fetchall())


def test_lowest_notes_of_large_ids_equal_sql(spark, tmp_path):
    con = duckdb.connect()
    # one user; of the two notes nearest the click, the SQL's order takes the one with a million less in its id and a pitch higher by one
    rows = "VALUES (5, 0, 'click', 10), (4000000, 1, 'view', 20), (1000000, 2, 'view', 21)"
    con.execute(f"copy (SELECT i::BIGINT AS event_id, TIMESTAMP '2024-01-01' + to_seconds(s) AS ts, 7::BIGINT AS user_id, label AS event_type, 1.5::DOUBLE AS value, '{{\"k\": ' || k || '}}' AS props FROM ({rows}) t(i, s, label, k)) to '{tmp_path}/events.parquet'")
    con.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet')")
    df = QUERIES["lowest_on_beats"](spark, str(tmp_path)).select("entity_id", "beat_id", "event_id", "lowest")
    assert [tuple(r) for r in df.collect()] == con.execute(SQL["lowest_on_beats"]).fetchall() == [(7, 5, 1_000_000, 20)]
