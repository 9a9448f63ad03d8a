"""Centroids, vector codes and language identification on small fixtures, held against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from tempora.llm import centroids, integer_vectors, language_id, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, `cluster` string, `_key` int, code string, lang_pred int"
DOCS = "doc_id long, text string, lang string, source string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, "k", 2) for i, v, label in rows], VECTORS)


def odd_vectors(seed=3, n=260, length=64):
    """Vectors in clumps, with copies, ties, nulls, other lengths, huge and non-finite components."""
    rng = random.Random(seed)
    clumps = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(12)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.08))) for x in rng.choice(clumps)], rng.choice([None, 0, 1])) for i in range(n)]
    rows += [(1000 + i, rows[7][1], None) for i in range(40)] + [rows[5], rows[5]]
    rows += [(2000, None, 1), (2001, [math.nan] + [0.0] * (length - 1), 1), (2002, [None] + [0.0] * (length - 1), 1), (2003, [math.inf] + [0.0] * (length - 1), 1)]
    rows += [(2004, [], 1), (2005, [1.0] * 7, 1), (2006, [0.5] * 24, 2), (2007, [-0.0] * length, 2), (None, [0.25] * length, 2), (2008, [3e30] + [0.0] * (length - 1), 2)]
    return rows


def whole(vector, scale, length):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    most = min(integer_vectors.magnitude_limit(length), 1 << 30)
    return [max(-most, min(most, math.floor(max(-2.0**30, min(2.0**30, x * scale))))) for x in vector]


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def lloyd(rows, books, rounds):
    """Plain rounds: the entry of each row, and the final entries."""
    for r in range(rounds + 1):
        of = [min(range(len(books)), key=lambda j: (apart(row, books[j]), j)) for row in rows]
        if r < rounds:
            for j in range(len(books)):
                mine = [row for row, k in zip(rows, of) if k == j]
                if mine:
                    books[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return of, books


def test_centroids(spark):
    rows = odd_vectors()
    kept = [(i, whole(v, 64, 64)) for i, v, _ in rows if v is not None and len(v) == 64 and whole(v, 64, 64)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    of, books = lloyd([v for _, v in kept], [list(v) for _, v in order[:16]], 3)
    far = [apart(v, books[j]) for (_, v), j in zip(kept, of)]
    sums = Counter()
    for j, d in zip(of, far):
        sums[j] += d
    digests = [hashlib.sha256(",".join(map(str, b)).encode()).hexdigest() for b in books]
    expected = [(i, j, d, sums[j], sum(far), digests[j]) for (i, _), j, d in zip(kept, of, far)]
    found = centroids.cluster(table(spark, rows).repartition(5))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert dict(found.dtypes)["cluster"] == "int" and dict(found.dtypes)["distance"] == "bigint"
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_centroids_of_few_or_no_rows(spark):
    rows = [(1, [0.0] * 64, 0), (2, [1.0] * 64, 0), (3, [1.0] * 64, None)]
    found = {r.vec_id: r for r in centroids.cluster(table(spark, rows)).collect()}
    assert found[2].cluster == found[3].cluster != found[1].cluster and found[1].inertia == 0
    assert centroids.cluster(table(spark, rows).where("vec_id = 9")).collect() == []
    assert centroids.cluster(table(spark, [(1, [0.0] * 63, 0)])).columns == centroids.cluster(table(spark, rows)).columns


def test_partial_distances_keep_ties_and_save_work():
    rng = np.random.default_rng(1)
    at = np.sort(rng.integers(-40, 40, (16, 64)), axis=0)
    rows = np.concatenate([at[rng.integers(0, 16, 500)] + rng.integers(-3, 4, (500, 64)), (at[3:4] + at[4:5]) // 2, at])
    at[9] = at[4]  # equal centroids: the smaller number wins
    far = ((rows[:, None] - at[None]) ** 2).sum(axis=2)
    which, best, added = centroids.nearest_centroids(rows, at, np.argsort(-rows.var(axis=0)))
    assert (which == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
    assert added < far.size * 64 / 2


@pytest.mark.parametrize("label_rows", [integer_vectors.BROADCAST_TOTALS, 0])
def test_vector_codes(spark, label_rows, monkeypatch):
    monkeypatch.setattr(integer_vectors, "BROADCAST_TOTALS", label_rows)
    rows = odd_vectors(5)
    kept = [(i, whole(v, 4096, 64), label) for i, v, label in rows if v is not None and len(v) == 64 and whole(v, 4096, 64)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    chosen, books = [], []
    for p in range(8):
        of, book = lloyd([v[8 * p : 8 * p + 8] for _, v, _ in kept], [list(v[8 * p : 8 * p + 8]) for _, v, _ in first], 6)
        chosen.append(of)
        books.append(book)
    error = [sum(apart(v[8 * p : 8 * p + 8], books[p][chosen[p][n]]) for p in range(8)) for n, (_, v, _) in enumerate(kept)]
    by_label = Counter()
    for (_, _, label), e in zip(kept, error):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    expected = [(i, "".join(f"{chosen[p][n]:02x}" for p in range(8)), error[n], by_label[label], digest) for n, (i, _, label) in enumerate(kept)]
    found = vector_codes.compress(table(spark, rows).repartition(5))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_vector_codes_of_few_or_no_rows(spark):
    rows = [(4, [0.0] * 16, 0), (2, [1.0] * 16, 0), (3, [1.0] * 16, None)]
    found = {r.vec_id: r for r in vector_codes.compress(table(spark, rows)).collect()}
    assert found[2].code == found[3].code == "00" * 8 and found[4].code == "02" * 8
    assert found[2].label_error == 0
    assert vector_codes.compress(table(spark, [(1, None, 0), (2, [1.0] * 7, 0)])).collect() == []


def test_elkan_bounds_hold_and_save_work():
    rng = np.random.default_rng(2)
    book = rng.integers(-3000, 3000, (16, 8))
    rows = np.concatenate([book[rng.integers(0, 16, 800)] + rng.integers(-150, 151, (800, 8)), (book[:15] + book[1:]) // 2])
    book[9] = book[4]
    chosen, upper, lower = vector_codes.first_bounds(rows, book)
    computed = 0
    for _ in range(8):
        new = book + rng.integers(-40, 41, book.shape)
        new[3], new[7] = book[3], new[2]
        upper, lower = vector_codes.shifted_bounds(chosen, upper, lower, np.where((new != book).any(axis=1), vector_codes.moved_up(book, new), 0.0))
        book = new
        far = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
        assert (np.sqrt(far[np.arange(len(rows)), chosen]) <= upper).all() and (np.sqrt(far) >= lower).all()
        chosen, upper, lower, n = vector_codes.elkan_step(rows, book, chosen, upper, lower)
        computed += n
        assert (chosen == far.argmin(axis=1)).all()
        assert (np.sqrt(far[np.arange(len(rows)), chosen]) <= upper).all() and (np.sqrt(far) >= lower).all()
    assert computed < 8 * far.size / 3


# --- language identification


SYLLABLES = {"aa": ["ka", "lo", "mi", "ster", "und"], "bb": ["que", "ción", "ñar", "el", "os"], "cc": ["ий", "ов", "ста", "не", "ра"]}


def speech(lang, seed, words=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 5))) for _ in range(words)).capitalize() + "."


def speeches():
    rows = [(i, speech(lang, i), lang) for i, lang in enumerate(random.Random(1).choices("aa bb cc".split(), k=150))]
    rows += [(200 + i, rows[3][1], rows[3][2]) for i in range(60)]  # copies
    rows += [(300, None, "aa"), (301, "", "bb"), (302, "12 34 ² _ !", "aa"), (303, "中文字符", None), (304, speech("bb", 9), None), (305, "ka" * 4000, None)]
    rows += [(306, "kalo! " * 30000, "bb"), (None, speech("aa", 77), "aa"), (307, "́ ́", None), (308, "ka,lo;mi-ster", "cc"), (308, "ka,lo;mi-ster", "cc")]
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "x") for i, t, lang in rows], DOCS)


def remainder(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4


def plain_judge(rows):
    """The method word by word, with dictionaries."""
    find = lambda text: [w for w in regex.findall(r"[\p{L}\p{M}]+", text.lower()) if regex.search(r"\p{L}", w)]
    train = {(lang, text) for i, text, lang in rows if text is not None and lang is not None and remainder(i) != 2}
    names = sorted({lang for lang, text in train if find(text)})
    times = {(lang, n): Counter() for lang in names for n in range(6)}
    for lang, text in train:
        for w in find(text):
            if len(w) <= 40:
                times[lang, 0][w] += 1
            for n in range(1, 6):
                m = w if n == 1 else f" {w} "
                times[lang, n].update(m[k : k + n] for k in range(len(m) - n + 1))
    total = {key: sum(c.values()) for key, c in times.items()}
    unknown = [1 + math.log10(max(total[lang, n] for lang in names)) for n in range(6)]
    cost = lambda g, n: [math.log10(total[lang, n] / times[lang, n][g]) if g in times[lang, n] else unknown[n] for lang in names]

    def word(w):
        if len(w) <= 40 and any(w in times[lang, 0] for lang in names):
            return cost(w, 0)
        for n in range(5, 0, -1):
            m = w if n == 1 else f" {w} "
            some = [cost(m[k : k + n], n) for k in range(len(m) - n + 1) if any(m[k : k + n] in times[lang, n] for lang in names)]
            if some:
                return [sum(x) / len(some) for x in zip(*some)]
        return [max(unknown)] * len(names)

    out = {}
    for i, text, _ in rows:
        words = Counter(find(text or ""))
        if not words:
            out[i] = ("und", 0.0)
            continue
        sums = [0.0] * len(names)
        for w, k in words.items():
            sums = [s + k * x for s, x in zip(sums, word(w))]
        likely = [math.exp(-min(700, (s - min(sums)) * math.log(10))) for s in sums]
        out[i] = (names[likely.index(max(likely))], max(likely) / sum(likely))
    return out


def test_languages(spark):
    rows = speeches()
    docs = docs_of(spark, rows).repartition(5)
    found = language_id.identify(docs, language_id.fit_languages(docs)).collect()
    assert len(found) == len(rows)
    expected = plain_judge(rows)
    for r in found:
        name, score = expected[r.doc_id]
        assert (r.lang_pred, round(r.score, 4)) == (name, pytest.approx(score, abs=2e-4)), r
    held = [(r, lang) for r in found for i, _, lang in rows if i == r.doc_id and i is not None and i < 150 and remainder(i) == 2]
    assert len(held) > 20 and all(r.lang_pred == lang for r, lang in held)


def test_languages_learn_from_training_folds_only(spark):
    rows = speeches()
    names = {i: {None: None, "aa": "bb", "bb": "cc", "cc": "aa"}[lang] if remainder(i) == 2 else lang for i, _, lang in rows}
    one, two = (language_id.fit_languages(docs_of(spark, some)) for some in (rows, [(i, t, names[i]) for i, t, _ in rows]))
    assert one.languages == two.languages and one.numbers == two.numbers and all((a == b).all() for a, b in zip(one.cost, two.cost))


def test_languages_with_a_small_sample_and_few_features(spark):
    rows = [(i, speech(lang, i), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 100)]
    docs = docs_of(spark, rows)
    model = language_id.fit_languages(docs, fit_rows=15, features=360)
    most = defaultdict(Counter)
    for n in range(6):
        assert len(model.cost[n]) <= 60
        most[n].update(model.knows[n].tolist())
        assert max(most[n].values()) <= 20
    right = [r.lang_pred == rows[r.doc_id][2] for r in language_id.identify(docs, model).collect()]
    assert np.mean(right) > 0.98
    assert language_id.fit_languages(docs, languages=2).languages == ["aa", "bb"]


def test_languages_without_rows(spark):
    docs = docs_of(spark, [(1, "some words", None), (2, None, "aa")])
    model = language_id.fit_languages(docs)
    assert {(r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()} == {("und", 0.0)}
    assert language_id.identify(docs.where("doc_id = 9"), model).collect() == []
