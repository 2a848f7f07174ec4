"""URL reputation, nearest neighbours, WARC bundles and source mixing."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import fair_mix, hash_search, url_reputation, warc_bundles
from emberlog.session import work_folder

# --- url reputation ------------------------------------------------------------------------

URLS = [(1, "HTTP://Blog.Example.COM/en/1?x#y"), (2, "https://www.example.com/en/"), (3, "http://a.net/es/x"), (4, "http://anet/es/x"), (5, None), (6, "no scheme"), (7, "ftp://x.co.uk?q"),
        (8, "http://shop.x.co.uk/a://b"), (9, "http://example.com"), (10, "x://10.0.0.1:80/fr/"), (11, "http://ÄB.net/fr/" + "p" * 100_000), (12, "http://a.org/1"), (12, "http://a.org/1")]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "url AS n", "1 AS suffix", "2 AS domain", "3 AS k")
    outcomes = spark.createDataFrame([], "host string, bad boolean")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judge(pages, outcomes).collect()}
    assert found[1] == ("blog.example.com", "/en/1", "example.com/en/", "block")
    assert found[2] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert found[3] == ("a.net", "/es/x", "net/es/", "block") and found[4] == ("anet", "/es/x", None, "allow")
    assert found[5][:2] == found[6][:2] == ("", "") and found[7][:2] == ("x.co.uk", "") and found[8][:2] == ("shop.x.co.uk", "/a://b")
    assert found[9] == ("example.com", "", None, "allow") and found[10][:3] == ("10.0.0.1:80", "/fr/", None) and found[11][0] == "Äb.net" and found[11][2] == "net/fr/"
    assert url_reputation.judge(pages.limit(0), outcomes).count() == 0 and url_reputation.judge(pages, outcomes).count() == len(URLS)
    with pytest.raises(ValueError):
        url_reputation.judge(pages.withColumn("verdict", F.lit(1)), outcomes)


def test_suffixes_and_domains(spark):
    hosts = ["a.b.example.com", "x.co.uk", "shop.x.co.uk", "localhost", "", "10.0.0.1", "org.uk"]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string").withColumn("s", url_reputation.suffix_of(F.col("h"))).withColumn("d", url_reputation.domain_of(F.col("h"), F.col("s"))).collect()
    assert [(r["s"], r["d"]) for r in rows] == [("com", "example.com"), ("co.uk", "x.co.uk"), ("co.uk", "x.co.uk"), ("", "localhost"), ("", ""), ("", "10.0.0.1"), ("org.uk", "org.uk")]


def test_shrinkage_follows_the_levels(spark):
    rng = random.Random(3)
    labels = [("bad.evil.org", rng.random() < 0.9) for _ in range(60)] + [(f"h{i}.evil.org", rng.random() < 0.8) for i in range(60)] + [(f"h{i % 30}.fine.org", rng.random() < 0.05) for i in range(300)] + [("x.other.com", None)]
    outcomes = spark.createDataFrame(labels, "host string, bad boolean")
    urls = [(1, "http://bad.evil.org/"), (2, "http://new.evil.org/"), (3, "http://new.fine.org/"), (4, "http://h1.fine.org/"), (5, "http://new.unseen.org/")]
    rows = {r["page_id"]: r for r in url_reputation.judge(spark.createDataFrame(urls, "page_id long, url string"), outcomes, rules=()).collect()}
    assert rows[1]["verdict"] == "block" and rows[3]["verdict"] == rows[4]["verdict"] == "allow"
    assert rows[1]["bad_rate"] > rows[2]["bad_rate"] > rows[5]["bad_rate"] > rows[3]["bad_rate"]
    assert all(r["bad_rate_low"] < r["bad_rate"] for r in rows.values())


# --- nearest neighbours --------------------------------------------------------------------

def vectors(seed, count, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    return (centres[rng.integers(0, 8, count)] + 0.4 * rng.normal(size=(count, dim))).astype(np.float32)


def brute_nearest(ids, x, step, k):
    out = {}
    for i, vec_id in enumerate(ids):
        if vec_id % step == 0:
            scores = (x.astype(float) * x[i].astype(float)).sum(1)
            at = [j for j in range(len(ids)) if ids[j] != vec_id]
            out[vec_id] = sorted(((-scores[j], ids[j]) for j in at))[:k]
    return out


def test_recall_and_exact_scores(spark):
    x = vectors(1, 1500)
    x[700:1100] = x[700]  # a very common vector
    x[5] *= 30  # norms differ
    ids = list(range(1500))
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS shard", "2 AS code")
    found = defaultdict(list)
    for r in hash_search.nearest(frame, query_step=20).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want, hit = brute_nearest(ids, x, 20, 20), 0
    exact = {(q, v): -s for q, rows in brute_nearest(ids, x, 20, 1500).items() for s, v in rows}
    for q, rows in want.items():
        assert [r[0] for r in found[q]] == list(range(1, 21))
        assert all(exact[q, v] == s for _, v, s in found[q])
        assert [(-s, v) for _, v, s in found[q]] == sorted((-s, v) for _, v, s in found[q])
        hit += len({v for _, v in rows} & {v for _, v, _ in found[q]})
    assert set(found) == set(want) and hit / (20 * len(want)) >= 0.9


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5])]
    found = hash_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), query_step=20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == [(0, 1, 1, 0.5), (0, 2, 20, 0.5), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert hash_search.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), query_step=20).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(4)
    codes, asked = rng.integers(0, 256, (3000, 4), dtype=np.uint8), rng.integers(0, 256, (50, 4), dtype=np.uint8)
    for radius in (0, 3, 4, 7, 9):
        shard = hash_search.Shard(codes, radius)
        for code in asked:
            near = np.flatnonzero(np.bitwise_count(codes ^ code).sum(1) <= radius)
            assert set(near) <= set(shard.probe(code))


def test_cells_do_not_change_the_result(spark):
    x = vectors(2, 300)
    frame = hash_search.usable(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"))
    hasher = hash_search.fit(frame, 300)
    indexed = hash_search.index(frame, hasher)
    hasher.radius = 8 * indexed.first()["code"].__len__()  # everything is within
    runs = [sorted(map(tuple, hash_search.search(indexed, indexed.filter("vec_id % 20 = 0"), hasher, 300, 15, shard_rows=s, block_queries=b).collect())) for s, b in ((8192, 2048), (50, 4))]
    assert runs[0] == runs[1] and len(runs[0]) == 300
    assert {r[0]: r[2] for r in runs[0] if r[1] == 1} == {q: rows[0][1] for q, rows in brute_nearest(list(range(300)), x, 20, 1).items()}


# --- WARC ----------------------------------------------------------------------------------

LONG = "é" * 700
PAGES = [(1, "http://a/ b\n", LONG), (2, "http://b/", LONG), (3, None, LONG), (4, "http://c/", "short"), (5, "http://d/", "short"), (6, "http://e/", None), (7, "http://f/", ""), (8, "http://g/", "\r\n\r\nWARC/1.1\r\n" * 90_000),
         (None, "http://h/", LONG), (3, None, LONG), (9, "http://i/", "x" * 999), (10, "http://i/", "x" * 999), (11, "é", "x" * 1000), (12, "é", "x" * 1000)]


def test_bundles_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS payload", "3 AS refers_to")
    folder, index = warc_bundles.archive(pages, frame_bytes=3000, bundle_bytes=2000)
    found = sorted(((int(r["record_id"]) if r["record_id"] else -1, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc_bundles.read_bundles(spark, folder).collect()), key=repr)
    data = [(-1 if i is None else i, (h or "").encode()) for i, _, h in PAGES]
    largest = {b: max(i for i, c in data if c == b) for _, b in data}
    want = [(i, *(("response", None) if len(b) < 1000 or i == largest[b] else ("revisit", str(largest[b]))), len(b), hashlib.sha1(b).hexdigest()) for i, b in data]
    assert found == sorted(want, key=repr)
    texts = {r["record_id"]: r["payload"] for r in warc_bundles.fetch(index, folder).collect()}
    assert texts["8"] == PAGES[7][2] and texts["3"] == LONG and texts["1"] == "" and texts["6"] == ""
    places = {(r["bundle"], r["frame"], r["offset"]): r["record_id"] for r in warc_bundles.read_bundles(spark, folder, payloads=True).collect()}
    assert {(r["bundle"], r["frame"], r["offset"]): r["record_id"] for r in index.collect()} == {k: v if v is not None else None for k, v in places.items()}


def test_frames_are_independent_and_listed(spark, tmp_path):
    import zstandard

    pages = spark.createDataFrame([(i, "http://a/", f"page {i} " * 200) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    folder, _ = warc_bundles.archive(pages, folder=str(tmp_path / "bundles"), frame_bytes=8000)
    files = sorted((tmp_path / "bundles").glob("*.warc.zst"))
    data = files[0].read_bytes()
    frames = warc_bundles.read_seek_table(data)
    assert len(frames) > 1
    at, packed, size = frames[-1]
    last = zstandard.ZstdDecompressor().decompress(data[at:at + packed], max_output_size=size)
    assert len(last) == size and last.startswith(b"WARC/1.1\r\n")


def test_archive_of_nothing(spark):
    folder, index = warc_bundles.archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.count() == 0 and warc_bundles.read_bundles(spark, folder).count() == 0


# --- mixing --------------------------------------------------------------------------------

def mix_rows(seed):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" for _ in range(rng.choice([1, 5, 60, 300]))), None, rng.choice(["a", "a", "a", "b", "c", "d", "ü", None])) for i in range(400)]
    return rows + [(900, None, None, "a"), (901, " \t\n", None, "b"), (902, "nbsp\xa0one", None, "c"), (902, "nbsp\xa0one", None, "c"), (None, "x y", None, "d"), (903, "w " * 30_000, None, "e"), (904, None, None, "empty")]


def water_levels(sizes, weights, total, repeats):
    """Share the budget by weight; what goes over a source's cap is shared again among the others."""
    target, open_sources, left = dict.fromkeys(sizes, 0.0), set(sizes), total
    while open_sources:
        weight = sum(weights[s] for s in open_sources)
        over = {s for s in open_sources if left * weights[s] / weight > repeats * sizes[s]}
        if not over:
            return {**target, **{s: left * weights[s] / weight for s in open_sources}}
        for s in over:
            target[s] = repeats * sizes[s]
            left -= target[s]
        open_sources -= over
    return target


def test_mix_meets_the_targets(docs):
    rows = mix_rows(1)
    found = fair_mix.mix(docs(rows, extra=True)).collect()
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len([w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w])
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = water_levels(sizes, {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    taken, longest = Counter(), Counter()
    for r in found:
        assert r["source_size"] == sizes[r["mix_source"]] and r["target"] == pytest.approx(want[r["mix_source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["mix_source"]] += r["taken"]
        longest[r["mix_source"]] = max(longest[r["mix_source"]], r["size"])
    assert len(found) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] + 1e-6
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert sorted(map(repr, found)) == sorted(map(repr, fair_mix.mix(docs(rows[::-1])).collect()))


def test_take_repeats_rows_as_often_as_they_are_taken(docs):
    rows = [r for r in mix_rows(2) if r[0] != 902]
    frame = docs(rows, extra=True)
    out = Counter(r["doc_id"] for r in fair_mix.take(frame).collect())
    assert out == Counter({r["doc_id"]: r["copies"] for r in fair_mix.mix(frame).collect() if r["copies"]})
    assert fair_mix.take(frame).columns == frame.columns


def test_mix_of_nothing_and_of_no_words(docs):
    assert fair_mix.mix(docs([])).count() == 0 and fair_mix.take(docs([])).count() == 0
    assert [(r["size"], r["target"], r["taken"]) for r in fair_mix.mix(docs([(1, None, None, "a"), (2, "", None, None)])).collect()] == [(0, 0.0, 0)] * 2
    assert [r["taken"] for r in fair_mix.mix(docs([(1, "a b c", None, "s")])).collect()] == [3]


def test_a_large_source_is_cut_into_slices(docs):
    assert math.isqrt(10_000) == 100
    rows = fair_mix.mix(docs([(i, "a b", None, "hot") for i in range(1000)])).collect()
    assert sum(r["taken"] for r in rows) == 3000


def test_folders_are_fresh(spark):
    assert work_folder(spark) != work_folder(spark)
