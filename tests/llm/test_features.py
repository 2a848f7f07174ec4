"""Token counts, importance resampling and hard negatives against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import hard_negatives, importance, token_counts
from emberlog.llm.workload import queries, vocabulary_path

# --- token counts --------------------------------------------------------------------------

SIGNS = "abcdestmrvl'' ''.!-<|>12 \n\té́ßΣİ漢字かな🙂0"


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.Vocabulary.read(vocabulary_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def awkward_texts() -> list[str]:
    draw = random.Random(3)
    texts = ["".join(draw.choice(SIGNS) for _ in range(draw.randrange(60))) for _ in range(3000)]
    texts += ["it's we'll they're I've 'sun '' 'l 'lx 're's 'r 'v", "<|endoftext|>a<|startoftext|>'s<|endoftext|", "x'<|endoftext|>s", "'", "   ", "a" * 3000, "漢字" * 1000, "'" * 300]
    texts += ["".join(chr(draw.choice([draw.randrange(1, 0xD7FF), draw.randrange(0xE000, 0x110000), draw.randrange(32, 127)])) for _ in range(30)) for _ in range(500)]
    return texts


def test_token_counts_equal_the_library(vocabulary, library):
    texts = awkward_texts()
    assert token_counts.Counter(vocabulary).count(texts).tolist() == library(texts)


def test_token_counts_do_not_depend_on_slices_chunks_or_dropped_states(vocabulary, library, monkeypatch):
    draw = random.Random(4)
    texts = [" ".join("".join(draw.choice("abcdeilnorst'é") for _ in range(draw.randrange(1, 300))) for _ in range(40)) for _ in range(20)]
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 100)
    monkeypatch.setattr(token_counts, "MAX_STATES", 200)
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", 7)
    assert token_counts.Counter(vocabulary).count(texts).tolist() == library(texts)


def test_chunk_maps_equal_a_plain_walk():
    classes = np.random.default_rng(5).integers(0, 9, 5000).astype(np.uint8)
    state, walked = token_counts.IDLE, []
    for c in classes:
        walked.append(state)
        state = token_counts.MOVES[state, c]
    for chunk in (1, 3, 64, 6000):
        assert token_counts.exit_states(classes, chunk).tolist() == walked


def test_token_counts_of_defined_cases(docs, vocabulary, library):
    texts = [None, "", "same text", "same text", "one two " * 60_000, "x" * 5000]
    frame = docs([(i // 2, t) for i, t in enumerate(texts)], extra=True).withColumn("n_tokens", F.lit(1)).withColumn("over_limit", F.lit(1))
    rows = token_counts.count(frame, vocabulary, 2048).collect()
    want = library([t or "" for t in texts])
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == sorted((i // 2, len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, want)))
    assert token_counts.count(docs([]), vocabulary, 2048).count() == 0


def test_token_count_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    assert {r["doc_id"]: r["n_tokens"] for r in queries()["op12_transducer_token_counts"](spark, folder).collect()} == want


# --- importance ----------------------------------------------------------------------------

def plain_grams(text: str | None) -> list[str]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, percent, min_words, buckets):
    hashed = [Counter(zlib.crc32(g.encode()) % buckets for g in plain_grams(t)) for _, t in rows]
    raw, wanted = Counter(), Counter()
    for c in hashed:
        raw.update(c)
    for t in target:
        wanted.update(zlib.crc32(g.encode()) % buckets for g in plain_grams(t))
    s, t = sum(raw.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for (doc_id, text), c in zip(rows, hashed):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in c.items())
        words = len([g for g in plain_grams(text) if " " not in g])
        out.append([doc_id, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, (r[:5] for r in out)), key=repr)


@pytest.mark.parametrize("text", [None, "", "  --  ", "A", "Ab cD", "x1 y_2 z-3 é ÀB\x00c", "a b  c", "word " * 70_000])
def test_grams_equal_plain_split(text):
    words, hashes = importance.gram_hashes(text)
    want = plain_grams(text)
    assert words == sum(" " not in g for g in want)
    assert sorted(hashes.tolist()) == sorted(zlib.crc32(g.encode()) for g in want)


def test_packed_counts_come_back():
    for found in ([], [0], [9999], [0, 1, 5000, 9999]):
        buckets, counts = importance.unpack(importance.pack(np.array(found, np.int64), np.arange(1, len(found) + 1) * 70_000))
        assert buckets.tolist() == found and counts.tolist() == [70_000 * (i + 1) for i in range(len(found))]


def test_resampling_equals_plain_version(spark, docs):
    draw = random.Random(6)
    rows = [(i % 150, " ".join(draw.choice(["alpha", "Beta", "gamma", "délta", "x1"]) for _ in range(draw.randrange(30)))) for i in range(200)]
    rows += [(None, "alpha beta gamma " * 4), (900, None), (901, ""), (902, "one")] + [(903, "same words here again " * 3)] * 5
    target = ["alpha alpha beta", None, "gamma délta"]
    frame = docs(rows, extra=True).withColumn("rank", F.lit(0)).withColumn("bucket", F.lit(0))
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = importance.resample(frame, goal, percent=20, min_words=5, buckets=97)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, target, 20, 5, 97)


def test_resampling_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id int, text string")
    assert importance.resample(docs([]), none).count() == 0
    rows = [(1, "a b c " * 10), (2, None)]
    assert sorted(map(tuple, importance.resample(docs(rows), none, percent=100).collect()), key=repr) == plain_resample(rows, [], 100, 20, 10_000)


# --- hard negatives ------------------------------------------------------------------------

def plain_negatives(rows, step):
    size = Counter(len(v) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v))
    size = min(size, key=lambda k: (-size[k], k), default=0)
    fine = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (anchor, av, al) in enumerate(fine):
        if anchor % step == 0:
            scored = [(-sum(x * y for x, y in zip(av, v)), i, label, at) for at, (i, v, label) in enumerate(fine) if at != a]
            for p in sorted(s for s in scored if s[2] == al)[:5]:
                fits = sorted(s[:2] for s in scored if s[2] != al and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0])[:3]
                out += [(anchor, p[1], rank, n[1], -p[0], -n[0]) for rank, n in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, step, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS block", "2 AS rank", "3 AS grp")
    return sorted(map(tuple, hard_negatives.mine(frame, F.col("label"), step, **options).collect()))


def test_negatives_equal_plain_search(spark):
    made = np.random.default_rng(7)
    centres = made.normal(size=(4, 6))
    rows = [(i, (centres[i % 4] + made.normal(size=6)).tolist(), int(made.integers(0, 3))) for i in range(400)]
    rows += [(1001, None, 1), (1002, [1.0] * 6, None), (None, [1.0] * 6, 1), (1003, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (1004, [float("nan")] * 6, 1), (1005, [float("inf")] * 6, 0), (1006, [1.0] * 5, 1), (1007, [0.0] * 6, 1)]
    want = plain_negatives(rows, 10)
    assert len(want) > 300 and mined(spark, rows, 10) == want
    assert mined(spark, rows, 10, block_rows=70, group_anchors=9) == want


def test_negatives_with_many_equal_rows_and_ids(spark):
    rows = [(i % 40, [1.0, 0.5] if i % 3 else [0.6, 0.3], i % 2) for i in range(200)]
    assert mined(spark, rows, 10, block_rows=64) == plain_negatives(rows, 10)


def test_negatives_of_empty_and_one_label_tables(spark):
    assert mined(spark, [], 5) == []
    assert mined(spark, [(i, [1.0, float(i)], 1) for i in range(20)], 5) == []


def test_large_components_are_exact():
    left, right = np.array([[1 << 23] * 64, [-(1 << 23)] * 64]), np.array([[(1 << 23) + 1] * 64])
    assert hard_negatives.products(left, right)[:, 0].tolist() == [64 * (1 << 23) * ((1 << 23) + 1), -64 * (1 << 23) * ((1 << 23) + 1)]


def test_bounds_hold_and_turn_blocks_away():
    made = np.random.default_rng(8)
    anchors, rows = made.integers(-99, 99, (20, 8)), made.integers(-99, 99, (500, 8))
    least, most = hard_negatives.score_bounds(anchors, rows.min(0)[None], rows.max(0)[None])
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(1)).all() and (most[:, 0] >= scores.max(1)).all()
    asked = hard_negatives.Asked(np.arange(20), np.arange(20), np.zeros(20, np.int64), anchors.astype(np.int32), np.column_stack([most[:, 0] + 1, most[:, 0] + 2]))
    assert not hard_negatives._asks_negatives(asked, least, most, np.array([1]), np.array([1])).any()


def test_hilbert_curve_visits_every_cell_by_single_steps():
    side = 8
    cells = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hard_negatives.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(side ** 3))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
