"""Small fixtures for every training-data operator, held against brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tempora.llm import ann, components, license_scan, media, mixing, packing, simhash, substring_dedup, suffix_array, toxicity, url_filter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(words))


# --- URL filters


def test_urls(spark):
    urls = [None, "", "no scheme", "http://net", "http://NET/", "https://a.b.net/x?y", "http://x.example.net/en/1", "http://example.net/enx", "http://example.com/de/#f", "http://notexample.com/de/", "ftp://x.org/fr/a", "http://org/fr", "x://h?q/net/", "http://net/://net/", "http://" + "a." * 300 + "net/" + "b/" * 500]
    pages = spark.createDataFrame([(i, u, 7, "k") for i, u in enumerate(urls)] + [(1, "", 7, "k")], "page_id long, url string, rule_host int, prefix string")
    rules = spark.createDataFrame(url_filter.RULES, url_filter.RULE_SCHEMA)
    found = [url_filter.filter_urls(pages.select("page_id", "url"), rules, broadcast_rules=n).collect() for n in (1000, 0)]
    assert sorted(map(str, found[0])) == sorted(map(str, found[1]))
    assert len(found[0]) == len(urls) + 1
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found[0]}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("net", "", None, "allow")
    assert got[4] == ("net", "/", "net/", "block")
    assert got[5] == ("a.b.net", "/x", "net/", "block")
    assert got[6][2:] == ("example.net/en/", "allow")
    assert got[7][2:] == ("net/", "block")
    assert got[8] == ("example.com", "/de/", "example.com/de/", "block")
    assert got[9][2] is None and got[11][2] is None
    assert got[10][2:] == ("org/fr/", "allow")
    clash = url_filter.filter_urls(pages.select("page_id", F.lit("x").alias("host"), "url", F.lit(1).alias("_row"), F.lit(2).alias("_e"), F.lit("y").alias("verdict")), rules)
    assert clash.columns == ["page_id", "url", "_row", "_e", "host", "path", "rule", "verdict"]
    assert sorted(map(str, clash.select("page_id", "url", "host", "path", "rule", "verdict").collect())) == sorted(map(str, url_filter.filter_urls(pages.select("page_id", "url"), rules).collect()))
    assert got[12] == ("h", "", None, "allow")
    assert got[14][2:] == ("net/", "block")


def test_urls_without_rules_or_pages(spark):
    rules = spark.createDataFrame([], url_filter.RULE_SCHEMA)
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert url_filter.filter_urls(pages, rules).first().verdict == "allow"
    some = spark.createDataFrame([("net", "/a", "block"), ("net", "/ab", "allow")], url_filter.RULE_SCHEMA)
    assert url_filter.filter_urls(pages.where("page_id = 2"), some).count() == 0
    deep = spark.createDataFrame([(1, "http://net/abc"), (2, "http://net/ax/"), (3, "http://x.net/")], "page_id long, url string")
    assert {r.page_id: r.rule for r in url_filter.filter_urls(deep, some).collect()} == {1: "net/ab", 2: "net/a", 3: None}


# --- SimHash


def brute_components(values, radius):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_tree_components_equal_brute_force():
    rng = random.Random(1)
    for radius in (0, 1, 4, 7):
        values = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(0, 9))) & (2**64 - 1) for b in [rng.getrandbits(64) for _ in range(4)] for _ in range(30)})
        rng.shuffle(values)
        assert simhash.grow_and_link(values, radius) == brute_components(values, radius)


def plain_simhash(text, words=4):
    found = text.encode().lower().split()
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


@pytest.mark.parametrize("max_shard", [4096, 3])
def test_simhash_documents(spark, max_shard, monkeypatch):
    base = prose(3, 300)
    near = [base.replace(base.split()[k * 7], "changed", 1) for k in range(12)]
    texts = [base, None, "", " \t\n", "one", "ONE", "a b c", base, prose(4, 80), "É b c d e", *near, "x " * 5000]
    monkeypatch.setattr(simhash.link_shards, "__defaults__", (max_shard,))
    prints = simhash.simhash(documents(spark, texts).withColumnRenamed("lang", "fp2"))
    rows = simhash.near_duplicates(prints, simhash.block_tables(), simhash.RADIUS).collect()
    assert len(rows) == len(texts)
    want = [plain_simhash(t or "") for t in texts]
    assert {r.doc_id: int.from_bytes(r.fp, "big") for r in rows} == dict(enumerate(want))
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(brute_components(want, 4)))
    assert simhash.near_duplicates(prints.where("doc_id < 0"), simhash.block_tables(), 4).count() == 0


def test_blocks_miss_no_pair():
    rng = random.Random(5)
    tables = simhash.block_tables()
    for _ in range(300):
        flipped = set(rng.sample(range(64), 4))
        assert any(not flipped & set(t) for t in tables)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    found = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def least(start):
        seen, stack = {start}, [start]
        while stack:
            for x in near[stack.pop()] - seen:
                seen.add(x)
                stack.append(x)
        return min(seen)

    assert found == {n: least(n) for n in near if near[n] - {n}}


# --- nearest neighbours


def test_nearest(spark):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, 8))
    rows[100:200] = rows[100]
    vectors = [(i, [float(x) for x in v], "x") for i, v in enumerate(rows)]
    odd = [(1000, None, "x"), (1001, [0.0] * 8, "x"), (1002, [1.0, None] + [0.0] * 6, "x"), (1003, [float("nan")] * 8, "x"), (1004, [1.0], "x"), (None, [1.0] * 8, "x"), (1020, [float("inf")] * 8, "x"), (1021, [], "x")]
    table = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>, part string")
    found = ann.nearest(table, F.col("vec_id") % 20 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r["rank"]
    assert sorted(got) == list(range(0, 400, 20))
    hits = 0
    for q, near in got.items():
        scores = rows @ rows[q]
        order = sorted((j for j in range(400) if j != q), key=lambda j: (-round(scores[j], 9), j))[:20]
        hits += len({v for v, _ in near} & set(order))
        assert all(abs(s - scores[v]) < 1e-9 for v, s in near)
    assert hits / (20 * len(got)) >= 0.9
    few = ann.nearest(table.where("vec_id < 5"), F.col("vec_id") % 20 == 0).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r["rank"])] == sorted(range(1, 5), key=lambda j: -(rows[j] @ rows[0]))
    assert ann.nearest(table.where("vec_id > 1000"), F.lit(True)).count() == 0


@pytest.mark.parametrize("times", [1, 2, 25])
def test_nearest_of_repeated_rows(times):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows = rng.normal(size=(60, 8))
    rows[10:15] = rows[10]
    ids = np.arange(60)
    ids[20:24] = 20  # one id with several vectors
    table = pa.table([pa.array(np.repeat(ids, times)), pa.array(np.repeat(rows, times, axis=0).tolist())], names=["vec_id", "embedding"])
    asked = [0, 10, 12, 20]
    queries = pa.table([pa.array(asked), pa.array(rows[asked].tolist())], names=["vec_id", "embedding"])
    found = ann.rank_block(20)(table, queries).to_pylist()
    for q in asked:
        scores = [float(sum(a * b for a, b in zip(rows[j], rows[q]))) for j in range(60)]
        want = sorted((-round(scores[j], 9), int(ids[j])) for j in range(60) for _ in range(times) if ids[j] != q)[:20]
        assert sorted((-round(r["score"], 9), r["vec_id"]) for r in found if r["query_id"] == q) == want


# --- WARC


def test_warc_round_trip(spark, tmp_path):
    long = "é" * 600 + "\r\n\r\nWARC/1.1\r\n"
    pages = [(1, "http://a/\r\nX: y", long), (5, None, long), (9, "u", long), (None, "u", long), (7, "u", None), (7, "u", "short"), (8, "u", "short"), (3, "u", "z" * 300_000), (9, "v", long)]
    table = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, refers_to int").select("page_id", "url", "html").repartition(3)
    index = warc.archive_pages(table, f"file://{tmp_path}/w")
    rows = warc.read_archives(index, range_bytes=500).collect()
    assert len(rows) == len(pages)
    want = Counter()
    for page, _, html in pages:
        data = (html or "").encode()
        revisit = html == long and page != 9
        want[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None)] += 1
    assert Counter(tuple(r) for r in rows) == want
    for part in (tmp_path / "w/archives").glob("*.gz"):  # each member stands alone, as the sidecar says
        raw, side = part.read_bytes(), part.with_name(part.name + ".idx").read_text().splitlines()
        ends = 0
        for line in side:
            offset, length, kind, _ = line.split("\t")
            assert int(offset) == ends
            ends += int(length)
            assert zlib.decompress(raw[int(offset) : ends], 31).startswith(f"WARC/1.1\r\nWARC-Type: {kind}".encode())
        assert ends == len(raw)


def test_warc_without_pages(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.archive_pages(empty, f"file://{tmp_path}/w")).count() == 0


def test_warc_damage_is_noticed(tmp_path):
    record = warc.page_record(1, "u", b"x" * 5000, None)
    (tmp_path / "bad.warc.gz").write_bytes(zlib.compress(record[:2000], wbits=31))
    with pytest.raises(ValueError):
        list(warc.normalise(f"file://{tmp_path}/bad.warc.gz", f"file://{tmp_path}/out.warc.gz"))
    assert base64.b32encode(hashlib.sha1(b"x" * 5000).digest()) in record


# --- toxicity


def toxic_corpus(spark, n=600):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = prose(1000 + i, 40).split()
        if bad:
            for w in rng.sample(["zorgle", "blimfark", "quonkish"], 2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(n, None), (n + 1, ""), (n + 1, "zorgle blimfark")]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(9999, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit_toxicity(docs, labels)
    scored = {}
    for r in toxicity.score_toxicity(docs, model).collect():
        scored.setdefault(r.doc_id, []).append(r.score)
    assert sum(map(len, scored.values())) == 603
    assert all(0 <= s <= 1 for v in scored.values() for s in v)
    held = [(r.toxic, scored[r.doc_id][0] >= toxicity.THRESHOLD) for r in labels.where("toxic is not null").collect() if r.doc_id in scored and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(t == g for t, g in held) / len(held) > 0.97
    assert scored[600][0] < toxicity.THRESHOLD and sorted(scored[601])[0] < toxicity.THRESHOLD <= sorted(scored[601])[1]


def test_toxicity_uses_training_folds_only(spark):
    docs, labels = toxic_corpus(spark, 300)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit_toxicity(docs, x) for x in (labels, flipped))
    assert a.voters.numbers == b.voters.numbers and np.allclose(a.weights, b.weights) and a.bias == b.bias


def test_toxicity_without_labels(spark):
    docs, labels = toxic_corpus(spark, 20)
    model = toxicity.fit_toxicity(docs, labels.where("doc_id < 0"))
    assert model.score(*model.voters.fire("idiot moron scum stupid", [])) > 0.5 > model.score(*model.voters.fire("fine words", []))


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.2
    votes = np.column_stack([np.where(truth, rng.random(4000) < p, rng.random(4000) < q) for p, q in [(0.7, 0.01), (0.6, 0.02), (0.5, 0.01), (0.2, 0.2)]]).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # a voter that repeats another
    posterior, info = toxicity.label_model(votes, 0.2, least_right=0.0)  # one voter here knows nothing
    assert ((posterior > 0.5) == truth).mean() > 0.9
    assert info["weight"][0] < info["weight"][1] and info["correlation"][0, 4] > 0.9


# --- packing


def test_packing(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    texts = [prose(i, n) for i, n in enumerate([1, 5, 30, 400, 3000, 7, 90, 12, 200, 800])] + [None, "", " ", "it's  a\n\ttest 's 中文 <|endoftext|>", "a <|endoftext|> <|endoftext|>b<|endo", "x" * 70_000, "é" * 3000]
    texts += [(prose(50, 30_000)[: packing.STRETCH - k] + " <|endoftext|> " + prose(51, 30_000)) for k in (0, 5, 14, 15, 16)]  # across the border of a stretch
    rows = packing.pack_documents(documents(spark, texts).withColumnRenamed("lang", "start").repartition(2), path, ["doc_id"]).collect()
    plain = Tokenizer.from_file(path)
    fill = Counter()
    for i, text in enumerate(texts):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024
    padding = sum(1024 - n for n in fill.values() if n & (n - 1))
    assert padding <= 0.02 * sum(fill.values()) + 2 * 1024
    assert packing.pack_documents(documents(spark, ["x"]).where("doc_id < 0"), path, ["doc_id"]).count() == 0


def test_packer_keeps_every_limit():
    rng = random.Random(4)
    packer = packing.Packer(100, 4, 60, min_cut=5)
    items = {k: (n := rng.randrange(1, 60) if k % 3 else rng.randrange(1, 12), int(n * rng.random())) for k in range(300)}
    for k, (n, loss) in items.items():
        packer.add(k, 0, n, loss)
    pieces, full = [], Counter()
    for bin_ in packer.pack(0):
        tokens = sum(p[2] for p in bin_)
        loss = sum(max(0, start + length - max(start, items[k][0] - items[k][1])) for k, start, length, _ in bin_)
        assert tokens <= 100 and len(bin_) <= 4 and loss <= 60
        assert [p[3] for p in bin_] == [sum(p[2] for p in bin_[:i]) for i in range(len(bin_))]
        full.update({"tokens": tokens == 100, "segments": len(bin_) == 4, "loss": loss == 60})
        pieces += bin_
    assert min(full[x] for x in ("tokens", "segments", "loss")) > 0  # each of the limits closes bins
    for k, (n, _) in items.items():
        at = 0
        for _, start, length, _ in sorted(p for p in pieces if p[0] == k):
            assert start == at
            at += length
        assert at == n


def test_packer_takes_the_largest_dot_product():
    packer = packing.Packer(100, 8, 50)
    for k, (n, loss) in enumerate([(40, 1), (38, 38), (60, 2), (30, 30)]):
        packer.add(k, 0, n, loss)
    assert packer.best((100, 8, 50)) == 1  # the loss it uses up counts as much as its tokens
    assert packer.best((100, 8, 20)) == 2
    assert packer.best((35, 8, 20)) == -1


def test_packing_masked_rows(spark):
    path = packing.default_tokenizer()
    docs = spark.createDataFrame([(i, prose(i, 40 + i), 25 * (i % 4)) for i in range(60)] + [(99, prose(99, 4000), 3000)], "doc_id long, text string, prompt int")
    rows = packing.pack_documents(docs.repartition(1), path, ["doc_id", "prompt"], tokens=256, segments=3, loss=128, masked="prompt").collect()
    used, bears, covered = Counter(), Counter(), Counter()
    for r in rows:
        used[r.sequence_id] += r.length
        bears[r.sequence_id] += max(0, r.start + r.length - max(r.start, r.prompt))
        covered[r.doc_id] += r.length
    assert max(used.values()) <= 256 and max(Counter(r.sequence_id for r in rows).values()) <= 3 and max(bears.values()) <= 128
    assert {r.doc_id: r.doc_tokens for r in rows} == covered


# --- media


def test_media_round_trip(spark, tmp_path):
    texts = [None, "", "a", "é" * 64, "x" * 64, prose(1, 2000), "a"]
    docs = documents(spark, texts).withColumnRenamed("lang", "member")
    docs = docs.unionByName(docs.where("doc_id = 2").selectExpr("cast(null as long) doc_id", "text", "member", "source", "n_chars"))
    folder = f"file://{tmp_path}/m"
    media.write_media(docs.repartition(2), folder, archive_bytes=1500).collect()
    rows = media.media_features(media.read_media(spark, folder, rangeBytes=600, batchBytes=500)).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        raw = (texts[r.doc_id] if r.doc_id is not None else "a") or ""
        raw = raw.encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    same = {(r.media_sha256, r.media_bytes, r.feature) for r in rows if r.n_bytes == 1}
    assert len(same) == 1
    for side in (tmp_path / "m").glob("*.idx"):  # without sidecars the tar headers are walked
        side.unlink()
    again = media.media_features(media.read_media(spark, folder, rangeBytes=600)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_media_failures_are_per_member(spark, tmp_path):
    folder = f"file://{tmp_path}/m"
    media.write_media(documents(spark, [prose(i, 50) for i in range(4)]).coalesce(1), folder).collect()
    (tar,) = (tmp_path / "m").glob("*.tar")
    data = bytearray(tar.read_bytes())
    data[600] ^= 255
    tar.write_bytes(bytes(data))
    rows = media.read_media(spark, folder, onError="report", tries=2).collect()
    assert sum(r.error is None for r in rows) == 3 and sum(r.media is None for r in rows) == 1
    with pytest.raises(Exception, match="checksum"):
        media.read_media(spark, folder, tries=1).collect()
    assert media.read_media(spark, f"file://{tmp_path}/nothing").count() == 0


def test_media_of_an_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/m"
    assert media.write_media(documents(spark, ["x"]).where("doc_id < 0"), folder).collect() == []
    found = media.media_features(media.read_media(spark, folder))
    assert found.count() == 0 and "media_sha256" in found.columns


def test_media_streams_are_opened_once_and_again_after_a_failure(tmp_path, monkeypatch):
    writer = media.ArchiveWriter(f"file://{tmp_path}/m/a.tar")
    for i in range(6):
        writer.add(f"{i}.png", media.encode_png(bytes([i]) * 64, 64))
    uri, _, size = writer.close()
    opened = []

    class Flaky:
        def __init__(self, stream):
            self.stream, self.reads = stream, 0

        def seek(self, place):
            self.stream.seek(place)

        def read(self, n):
            self.reads += 1
            if len(opened) == 2 and self.reads == 3:
                raise OSError("the line is down")
            return self.stream.read(n)

        def close(self):
            self.stream.close()

    class Store:
        def __init__(self, fs):
            self.fs = fs

        def get_file_info(self, x):
            return self.fs.get_file_info(x)

        def open_input_file(self, path):
            opened.append(path)
            return self.fs.open_input_file(path) if path.endswith(".idx") else Flaky(self.fs.open_input_file(path))

    plain = media.at
    monkeypatch.setattr(media, "at", lambda u: (Store(plain(u)[0]), plain(u)[1]))
    reader = media.MediaReader({"path": f"{tmp_path}/m", "batchbytes": "100"})
    found = [r for batch in reader.read(media.ByteRange(uri, size, 0, size)) for r in batch.to_pylist()]
    assert [r["member"] for r in found] == [f"{i}.png" for i in range(6)] and all(r["error"] is None for r in found)
    assert len(opened) == 3  # the sidecar, the archive, and the archive after the failure


# --- repeated strings


def test_suffix_array_equals_sorting():
    rng = random.Random(2)
    for _ in range(400):
        text = [rng.randrange(1, rng.choice([2, 3, 4, 11])) for _ in range(rng.randrange(0, 50))] + [0]
        assert suffix_array.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_spans(texts, span):
    seen = Counter(t[s : s + span] for t in texts for s in range(len(t) - span + 1))
    return [substring_dedup.merged([(s, s + span) for s in range(len(t) - span + 1) if seen[t[s : s + span]] > 1]) for t in texts]


@pytest.mark.parametrize("max_contexts", [4000, 1])
def test_repeated_strings(spark, max_contexts, monkeypatch):
    shared, edge = prose(1, 200), prose(2, 60)[:300]
    texts = [prose(3, 100) + shared + prose(4, 50), shared[5:900] + prose(5, 30), prose(6, 90), None, "", "é" * 900, "ab" * 700, edge + prose(7, 90), edge + prose(8, 90), prose(9, 300), prose(9, 300), "x" * 399, "x" * 399, prose(10, 40) + "é" + shared[100:560] + "ü"]
    texts += [prose(20 + i, 20) + shared[200 + i : 700 + 3 * i] for i in range(20)]
    monkeypatch.setattr(substring_dedup, "STRETCH", 700)
    monkeypatch.setattr(substring_dedup.repeated_spans, "__defaults__", (400, 96, max_contexts))
    rows, cut = substring_dedup.remove_repeats(documents(spark, texts).withColumnRenamed("lang", "key"))
    found = {bytes(r.of): r for r in cut.collect()}
    assert sorted(r.doc_id for r in rows.collect()) == list(range(len(texts)))
    raw = [(t or "").encode() for t in texts]
    for r in rows.collect():
        data, spans = raw[r.doc_id], brute_spans(raw, 400)[r.doc_id]
        got = found.get(bytes(r.key))
        assert r.n_bytes == len(data)
        assert (got.n_removed, got.n_spans) == (sum(b - a for a, b in spans), len(spans)) if spans else got is None
        if spans:
            edges = [0, *[e for p in spans for e in p], len(data)]
            assert bytes(got.kept) == b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def test_repeated_strings_query_gives_the_text_that_remains(spark, tmp_path):
    shared = prose(41, 200)[:500]
    texts = [prose(42, 40) + shared, shared + prose(43, 40), "é" + shared[:399] + "x", "è" + shared[:399] + "y", prose(44, 90), prose(45, 300), prose(45, 300), None, ""]
    texts += ["ü".join((prose(46, 30), "é" + prose(47, 150)[:450])), prose(48, 30) + "©" + prose(47, 150)[:450]]  # é and © share their last byte
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    out = substring_dedup.op8_suffix_dedup(spark, str(tmp_path))
    assert out.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == len(texts)
    raw = [(t or "").encode() for t in texts]
    for i, (data, spans) in enumerate(zip(raw, brute_spans(raw, 400))):
        edges = [0, *[e for p in spans for e in p], len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert found[i][1:5] == (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        assert found[i].text == kept.decode(errors="replace")
    assert shared not in found[0].text and found[5].text == found[7].text == "" and found[4].text == texts[4]
    assert "\ufffd" in found[9].text


def test_repeated_strings_query_cuts_passages_of_over_fifty_words(spark, tmp_path):
    rng = random.Random(50)
    passages = [prose(600 + i, 55 + i) for i in range(6)] + ["é" + prose(620, 55) + "ü"]
    assert all(240 <= len(p.encode()) < 400 and len(p.split()) > 50 for p in passages)
    texts = [f"{prose(700 + 2 * i + k, rng.randrange(20, 60))} {p} {prose(800 + 2 * i + k, rng.randrange(20, 60))}" for i, p in enumerate(passages) for k in range(2)]
    # runs of several passages, of which some windows of 400 bytes are repeated and others not; one ends within a character
    texts += [prose(630, 30) + passages[0][:300] + passages[1][5:300] + prose(631, 30), passages[0][20:300] + passages[1][5:290], prose(632, 20) + "é" + prose(633, 120)[:410] + "x", "©" + prose(633, 120)[:410] + "ü" + passages[2]]
    texts += [prose(634, 40), None, "", prose(635, 60)[:260], prose(635, 60)[:260], prose(636, 300), prose(636, 300), prose(637, 20) + prose(636, 300)[200:650], "ab" * 300]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    out = substring_dedup.op8_suffix_dedup(spark, str(tmp_path))
    found = {r.doc_id: r for r in out.collect()}
    raw = [(t or "").encode() for t in texts]

    def without(data, spans):
        edges = [0, *[e for p in spans for e in p], len(data)]
        return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))

    for i, (data, spans, shorter) in enumerate(zip(raw, brute_spans(raw, 400), brute_spans(raw, 240))):
        kept = without(data, spans)
        assert found[i][1:5] == (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        assert found[i].text_without_passages == without(data, substring_dedup.whole_characters(data, shorter)).decode()
    assert len(found) == len(texts) and all(p not in found[2 * i + k].text_without_passages for i, p in enumerate(passages) for k in range(2))
    assert found[4].n_removed == 0 and found[4].text == texts[4] and found[18].text_without_passages == texts[18]


def test_repeated_strings_at_stretch_borders(spark):
    border, texts = substring_dedup.STRETCH, []
    for i, before in enumerate((0, 1, 60, 150, 200, 250, 330, 399, 400, 410, 450)):  # bytes of the shared string ahead of the border
        shared = prose(100 + i, 120)[: 400 + i * 5]
        start = border - before
        texts += [(prose(200 + i, 26_000)[:start] + shared + prose(300 + i, 100)), prose(400 + i, 20) + shared + prose(500 + i, 20)]
        assert texts[-2].index(shared) == start
    rows, cut = substring_dedup.remove_repeats(documents(spark, texts))
    found = {bytes(r.of): r for r in cut.collect()}
    raw = [t.encode() for t in texts]
    spans = brute_spans(raw, 400)
    for r in rows.collect():
        want = spans[r.doc_id]
        edges = [0, *[e for p in want for e in p], len(raw[r.doc_id])]
        got = found[bytes(r.key)]
        assert (got.n_removed, got.n_spans) == (sum(b - a for a, b in want), len(want))
        assert bytes(got.kept) == b"".join(raw[r.doc_id][a:b] for a, b in zip(edges[::2], edges[1::2]))


def test_whole_characters():
    data = "aéé€b".encode()
    for start in range(len(data) + 1):
        for end in range(start, len(data) + 1):
            for a, b in substring_dedup.whole_characters(data, [(start, end)]):
                assert start <= a < b <= end
                (data[:a] + data[b:]).decode()


# --- licences


def test_licenses(spark):
    texts = ["Released under the MIT License.", "mit-LICENSE and the Apache\tLicense, GNU General Public License", None, "", "mit  license é", "éмit license", prose(1, 3000) + " Licensed under CC BY-NC 4.0. " + prose(2, 50), "general public mit license license", "This work is licensed under the GNU General Public License, version 3.", "the the of license " * 2000, "permission is hereby granted to nobody"]
    got = {r.doc_id: r for r in license_scan.scan_licenses(documents(spark, texts).select("doc_id", "text", "lang")).collect()}
    import re

    for i, text in enumerate(texts):
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        places, labels = [], set()
        for phrase, label in license_scan.BASE:
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (got[i].n_words, sorted(got[i].base_starts), got[i].base_labels) == (len(words), sorted(places), sorted(labels))
        assert labels <= set(got[i].labels) and 0 <= got[i].score <= 1
    assert got[6].labels == ["cc-by-nc"] and got[8].labels == ["gpl"] and got[9].labels == [] and got[10].labels == []
    assert license_scan.scan_licenses(documents(spark, ["x"]).where("doc_id < 0").select("doc_id", "text")).count() == 0


def test_licenses_of_a_file_that_holds_them_all(spark):
    passages = [p for _, p, _ in license_scan.TEMPLATES]
    texts = [". ".join(f"{prose(i, 30)} {p}" for i, p in enumerate(passages))] + ["licensed under cc by nc 4 0 in the public domain"] * 40
    got = {r.doc_id: r for r in license_scan.scan_licenses(documents(spark, texts).select("doc_id", "text")).collect()}
    assert got[0].labels == sorted({label for label, _, _ in license_scan.TEMPLATES}) and got[0].score == pytest.approx(1)
    assert got[1].labels == ["cc-by-nc"]


def plain_license_scan(texts):
    """Every template tried at every place of every text, with dictionaries."""
    import math
    import re

    words = [re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t or "")) for t in texts]
    holds = Counter(w for ws in words for w in set(ws))
    idf = lambda w: math.log((1 + len(texts)) / (1 + holds[w])) + 1e-6
    out = []
    for ws in words:
        at = lambda p, k: 0 <= k and ws[k : k + len(p)] == p
        labels = {label for p, label in license_scan.BASE if any(at(p.split(), k) for k in range(len(ws)))}
        best = 0.5 if labels else 0.0
        for label, passage, musts in license_scan.TEMPLATES:
            ps = passage.split()
            weight = sum(map(idf, ps))
            keys = [(m.split(), next(i for i in range(len(ps)) if ps[i : i + len(m.split())] == m.split())) for m in musts]
            for k in range(-len(ps), len(ws)):
                if any(at(m, k + i) for m, i in keys):
                    share = sum(idf(p) for i, p in enumerate(ps) if 0 <= k + i < len(ws) and ws[k + i] == p) / weight
                    if share >= license_scan.MIN_SHARE:
                        labels.add(label)
                        best = max(best, share)
        out.append((sorted(labels), best))
    return out


def test_license_labels_equal_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", "the software"]
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            label, passage, musts = rng.choice(license_scan.TEMPLATES)
            ws = passage.split()
            for _ in range(rng.randrange(0, 1 + len(ws) // 2)):  # words lost, changed and put in
                k = rng.randrange(len(ws))
                ws[k : k + 1] = rng.choice([[], ["xyzzy"], [ws[k], "plugh"]])
                ws = ws or ["x"]
            parts.append(rng.choice([" ".join(ws).upper(), ", ".join(ws)]) + rng.choice([". ", "\n"]) + prose(rng.random(), rng.randrange(5)))
        texts.append(" ".join(parts))
    docs = documents(spark, texts).select("doc_id", "text", F.lit("mine").alias("labels"), F.lit(1).alias("_row"), F.lit(2).alias("_hits"))
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert found[0]._row == 1 and found[0]._hits == 2
    for i, (labels, score) in enumerate(plain_license_scan(texts)):
        assert (found[i].labels, found[i].score) == (labels, pytest.approx(score, abs=1e-6)), texts[i]


def test_votes_grow_with_the_text_only(spark):
    """A hit once carried all phrase places of its file: 16,000 repeats then shuffled a gigabyte."""
    texts = ["mit license " * 20_000, "released under the mit license " * 8_000, "nothing"]
    found = {r.doc_id: r for r in license_scan.scan_licenses(documents(spark, texts).select("doc_id", "text")).collect()}
    assert len(found[0].base_starts) == 20_000 and found[0].labels == ["mit"]
    assert found[1].score == pytest.approx(1) and len(found[1].base_starts) == 8_000


# --- mixing


def water(sizes, weights, share, most):
    budget, capped = share * sum(sizes), set()
    while True:
        left = budget - sum(most * sizes[i] for i in capped)
        open_ = [i for i in range(len(sizes)) if i not in capped]
        level = left / sum(weights[i] for i in open_) if open_ else 0
        more = {i for i in open_ if weights[i] * level > most * sizes[i]}
        if not more:
            return [most * sizes[i] if i in capped else weights[i] * level for i in range(len(sizes))]
        capped |= more


@pytest.mark.parametrize("buckets", [65_536, 2])
def test_mixing(spark, buckets):
    rng = random.Random(3)
    names = ["b", "a", None, "é", "Z", "c"]
    sources = [names[min(5, int(rng.random() ** 2 * 6))] for _ in range(400)]
    texts = [" ".join(["w"] * rng.randrange(0, 200)) if rng.random() < 0.97 else None for _ in sources]
    docs = documents(spark, texts, sources).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    rows = mixing.mix_sources(docs, buckets=buckets).collect()
    assert len(rows) == len(texts)
    order = sorted({s for s in sources if s is not None}) + [None]
    size = {s: sum(len((t or "").split()) for t, x in zip(texts, sources) if x == s) for s in order}
    want = water([size[s] for s in order], [[3, 1, 2][i % 3] for i in range(len(order))], 1.5, 2)
    for s, target in zip(order, want):
        mine = [r for r in rows if r.source == s]
        assert all(abs(r.target - target) < 1e-6 and r.source_size == size[s] and 0 <= r.copies <= 2 for r in mine)
        assert abs(sum(r.copies * r.size for r in mine) - target) <= 100
    again = mixing.mix_sources(docs.repartition(3), buckets=buckets).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.mix_sources(docs.where("doc_id < 0")).count() == 0
    empty = spark.createDataFrame([(1, None, 0), (2, "a", 0), (3, "a", 1), (4, "b", 5)], "doc_id long, source string, size long")
    assert {r.doc_id: r.copies for r in mixing.mix_sources(empty).collect()}[1] == 0
    assert all(r.copies <= 2 for r in mixing.mix_sources(empty).collect())
    clash = mixing.mix_sources(docs.withColumns({"_u": F.lit(5), "target": F.lit("t"), "_bucket": F.lit("b")}), buckets=buckets)
    assert clash.columns == ["doc_id", "source", "size", "_u", "_bucket", "source_size", "target", "copies"]
    assert sorted(str((r.doc_id, r.copies, r.target)) for r in clash.collect()) == sorted(str((r.doc_id, r.copies, r.target)) for r in rows)


def expected_copies(sizes, target, most=2):
    """The level found by halving."""
    weight = [8 + max(1, s.bit_length()) for s in sizes]
    low, high = 0.0, 10.0
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(most, level * w) * s for w, s in zip(weight, sizes)) < target else (low, level)
    return [min(most, high * w) for w in weight]


def test_chances_of_documents(spark):
    """Chances differ between documents, add up to the target, and are met over many sources of equal sizes."""
    rng = random.Random(4)
    kinds = {"a": [int(2 ** rng.uniform(0, 12)) for _ in range(60)] + [0, 0], "b": [30] * 25, "c": [3, 700, 90] * 10}
    runs, sizes = 80, [(kind, place, size) for kind, ns in kinds.items() for place, size in enumerate(ns)]
    rows = [(i, f"{kind}{run:02}", size, place) for i, (run, (kind, place, size)) in enumerate((run, one) for run in range(runs) for one in sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, place int").repartition(3)
    taken, target = Counter(), {}
    for r in mixing.mix_sources(docs, weights=(1,), share=0.9).collect():
        taken[r.source[0], r.place] += r.copies
        target[r.source[0]] = r.target
    for kind, ns in kinds.items():
        want = expected_copies(ns, target[kind])
        assert sum(w * n for w, n in zip(want, ns)) == pytest.approx(target[kind], rel=1e-6)
        gaps = [(taken[kind, i] / runs - w) / max(0.02, ((w % 1) * (1 - w % 1) / runs) ** 0.5) for i, (w, n) in enumerate(zip(want, ns)) if n]
        assert max(map(abs, gaps)) < 5 and abs(np.mean(gaps)) < 0.6, (kind, gaps)
    assert len({round(w, 6) for w in expected_copies(kinds["a"], target["a"])}) > 5


def test_rows_without_ids_are_told_apart(spark):
    docs = spark.createDataFrame([(None, "s", 10, k) for k in range(300)], "doc_id long, source string, size long, k long")
    alike, apart = (mixing.mix_sources(docs.withColumn("_q", F.lit("x")), share=0.5, tell=tell).collect() for tell in (None, "k"))
    assert sum(r.copies for r in alike) == sum(r.copies for r in apart) == 150
    some = docs.select(mixing.document_uniform(F.col("doc_id"), "x", F.col("k")).alias("u")).distinct().count()
    assert some == 300
