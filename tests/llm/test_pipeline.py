"""The corpus pipeline on a small corpus with planted cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tempora.llm import near_sets, substring_dedup
from tempora.llm.packing import default_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"
BAD = ["zorgle", "blimfark", "quonkish"]


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """150 plain documents, 30 toxic, copies, near copies, a shared passage, and odd rows."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(180):
        text = words(i, rng.randrange(60, 200))
        if i >= 150:
            for w in rng.sample(BAD, 2):
                text.insert(rng.randrange(len(text)), w)
        rows.append((i, " ".join(text), "en", f"s{i % 4}"))
        labels.append((i, 1, int(i >= 150)))
    copy = rows[3][1]
    near = copy.split()
    near[len(near) // 2] = "changed"
    passage = " ".join(words(999, 60))
    rows += [(200, copy, "en", "s0"), (201, copy, "de", None), (202, " ".join(near), "en", "s1")]
    rows += [(210 + k, " ".join(words(500 + k, 80)) + " é" + passage + "ü " + " ".join(words(600 + k, 80)), "en", "s2") for k in range(3)]
    rows += [(220, None, None, None), (221, "", "en", "s0"), (222, "one", "en", "s0"), (222, "one", "en", "s0"), (None, " ".join(words(700, 50)), "en", "s1")]
    rows += [(230, " ".join(words(701, 30_000)), "en", "s3")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, 1, "k") for r in rows], SCHEMA)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, passage


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_the_columns(spark, corpus):
    folder, rows, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    clean = stage("toxicity")(spark, docs, folder)
    kept = [r.doc_id for r in clean.collect()]
    assert clean.columns == corpus_pipeline.COLUMNS
    assert len([i for i in kept if i is not None and 150 <= i < 180]) == 0
    assert len(kept) == len(rows) - 30

    single = stage("near_duplicates")(spark, clean, folder)
    assert single.columns == corpus_pipeline.COLUMNS
    left = [r.doc_id for r in single.collect()]
    assert {3, 200, 201, 202} & set(left) == {3}
    assert left.count(222) == 1 and {220, 221} & set(left) == {220} and None in left
    assert len(left) == len(kept) - 5

    cut = stage("repeated_passages")(spark, single, folder).collect()
    before = {r.doc_id: r for r in single.collect()}
    assert sorted(map(str, (r.doc_id for r in cut))) == sorted(map(str, left))
    for r in cut:
        if r.doc_id in (210, 211, 212):
            assert passage[5:-5] not in r.text and r.n_chars == len(r.text) < before[r.doc_id].n_chars - len(passage) + 20
        else:
            assert r == before[r.doc_id]

    mixed = stage("mixing")(spark, single, folder)
    assert mixed.columns == corpus_pipeline.COLUMNS
    assert set(mixed.collect()) <= set(single.collect())
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2


def test_run_packs_what_the_stages_leave(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(f(spark, docs, folder), "t")
    tokenizer = Tokenizer.from_file(default_tokenizer())
    want = {}
    for r in docs.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want[r.doc_id] = want.get(r.doc_id, 0) + len(ids)
    got = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_stages_on_an_empty_table(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < -1")
    for _, f in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(f(spark, docs, folder), "t")
    assert docs.count() == 0


def left_of(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return sorted(((r.doc_id, r.text) for r in stage("near_duplicates")(spark, docs.repartition(3), "").collect()), key=str)


def test_rows_of_one_doc_id_are_judged_by_their_groups(spark):
    a, b, c, d = (" ".join(words(800 + i, 80)) for i in range(4))
    rows = [(7, a), (7, b), (3, b), (None, c), (None, d), (None, d), (None, a)]
    assert left_of(spark, rows) == sorted([(7, a), (3, b), (None, c), (None, d)], key=str)


def changed(text, spots, mark):
    return " ".join(mark + str(k) if k in spots else w for k, w in enumerate(text))


def test_pairs_from_a_similarity_of_four_fifths_are_linked_and_no_others(spark):
    # 300 words have 296 shingles; a changed word in five shingles' midst takes five of them
    near, far = set(range(10, 70, 10)), set(range(10, 100, 10))  # 266 of 326: 0.816; 251 of 341: 0.736
    rows = []
    for i in range(150):
        text = words(2000 + i, 300)
        rows += [(4 * i, " ".join(text)), (4 * i + 1, changed(text, near, "n")), (4 * i + 2, changed(text[::-1], far, "f")), (4 * i + 3, " ".join(text[::-1]))]
    assert [i for i, _ in sorted(left_of(spark, rows))] == [i for i, _ in rows if i % 4 != 1]


def test_one_line_repeated_does_not_make_copies(spark):
    line = " ".join(words(900, 12)) + " "
    rows = [(i, line * 60 + " ".join(words(901 + i, 100))) for i in range(4)]
    assert [i for i, _ in left_of(spark, rows)] == [0, 1, 2, 3]


@pytest.mark.parametrize("most", [1 << 20, 200])
def test_groups_equal_brute_force(spark, most):
    rng, texts = random.Random(5), [None, "", "one", "One"]
    for i in range(12):
        text = words(3000 + i, 60)
        texts += [changed(text, set(rng.sample(range(60), rng.randrange(4))), "x") for _ in range(8)]
    sets = [frozenset(near_sets.shingle_set(t, 5).tolist()) for t in texts]
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    docs = spark.createDataFrame([(i, str(t or "").encode(), t) for i, t in enumerate(texts)], "key long, digest binary, text string")
    found = {}
    for r in near_sets.similar_groups(docs, 5, 0.8, most).collect():
        found.setdefault(bytes(r.group), set()).add(r.key)
    want = {}
    for i, g in enumerate(group):
        want.setdefault(g, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_held_out_fold_is_crc32_of_the_text(spark):
    from tempora.llm.toxicity import fold

    got = {r.id: r.f for r in spark.range(50).select("id", fold(F.col("id")).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 for i in range(50)}
    assert substring_dedup.SPAN == 400


def test_near_copies_meet_by_their_fingerprints(spark):
    text = " ".join(words(4000, 2000))
    texts = [text, changed(text.split(), {1000}, "x"), " ".join(words(4001, 300)), " ".join(words(4001, 300)[::-1])]
    docs = spark.createDataFrame([(i, str(i).encode(), t) for i, t in enumerate(texts)], "key long, digest binary, text string")
    prints = {r.key: r for r in near_sets.print_rows(docs, 5).collect()}
    for i, t in enumerate(texts):
        found = [int(h) for h in near_sets.shingle_set(t, 5)]
        want = sum((2 * sum(h >> bit & 1 for h in found) > len(found)) << bit for bit in range(64))
        assert int.from_bytes(prints[i].fp, "big") == want
    apart = (int.from_bytes(prints[0].fp, "big") ^ int.from_bytes(prints[1].fp, "big")).bit_count()
    assert apart <= 4
    ties = near_sets.fingerprint_ties(near_sets.print_rows(docs, 5)).collect()
    assert {frozenset((bytes(r.a), bytes(r.b))) for r in ties} == {frozenset(bytes(prints[i].node) for i in (0, 1))}  # once for each shard they share
