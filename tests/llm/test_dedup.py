"""Exact, near and string deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from emberlog.llm import bit_filter, blocks, bloom_dedup, jaccard_join, suffix_dedup
from emberlog.llm.components import components


def words(rng, count, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


# --- exact ---------------------------------------------------------------------------------

EXACT = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (6, "a"), (None, "c"), (7, "c"), (8, "x" * 300_000), (9, "x" * 300_000), (10, "solo")]


@pytest.mark.parametrize("limit", [bloom_dedup.BROADCAST_BYTES, 0])
def test_exact_groups(docs, limit):
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in bloom_dedup.annotate(docs(EXACT, extra=True), broadcast_bytes=limit).collect()}
    assert found == {1: (6, 3), 2: (6, 3), 6: (6, 3), 3: (4, 2), 4: (4, 2), 5: (5, 1), None: (7, 2), 7: (7, 2), 8: (9, 2), 9: (9, 2), 10: (10, 1)}


def test_exact_keeps_one_of_each_with_all_columns(docs):
    frame = docs([*EXACT, (6, "a")], extra=True)
    kept = bloom_dedup.keep_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7, 9, 10]


def test_exact_of_nothing_and_of_clashes(docs):
    assert bloom_dedup.annotate(docs([])).count() == 0
    assert bloom_dedup.keep_copies(docs([])).count() == 0
    with pytest.raises(ValueError):
        bloom_dedup.keep_copies(docs(EXACT).selectExpr("*", "1 AS bloom_hit"))


def test_most_single_rows_miss_the_filter(docs):
    rows = bloom_dedup.annotate(docs([(i, f"text {i}") for i in range(2000)] + [(5000, "text 7")]))
    hits = [r["doc_id"] for r in rows.filter("bloom_hit").collect()]
    assert {7, 5000} <= set(hits) and len(hits) < 200


# --- near ----------------------------------------------------------------------------------

def brute_components(rows, k, percent):
    sets = []
    for _, text in rows:
        w = (text or "").split()
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in w]
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    changed = True
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    least = {}
    for (doc, _), x in zip(rows, label):
        least[x] = min(least.get(x, doc), doc)
    return {doc: (len(s), least[x] if s else doc) for (doc, _), s, x in zip(rows, sets, label)}


def near_rows(seed):
    rng = random.Random(seed)
    rows, number = [], 0
    for _ in range(25):
        base = words(rng, rng.randrange(3, 120), 60)
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"W{rng.randrange(60)}"
            rows.append((number, " ".join(copy)))
            number += 1
    return rows + [(900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "ONE two"), (905, "one"), (906, " ".join(words(rng, 20_000)))]


@pytest.mark.parametrize("k, percent, whole", [(3, 90, 2048), (5, 80, 2048), (2, 50, 3)])
def test_components_equal_brute_force(docs, monkeypatch, k, percent, whole):
    monkeypatch.setattr(jaccard_join, "CELL_CLASSES", 4 if whole == 3 else 512)
    rows = near_rows(k)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.cluster(docs(rows, extra=True), k=k, percent=percent).collect()}
    assert found == brute_components(rows, k, percent)


def test_near_copies_of_nulls_repeats_and_nothing(docs):
    frame = docs([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "z"), (3, None)])
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in jaccard_join.cluster(frame).collect()) == [(0, 1), (1, 1), (1, 1), (2, 2), (3, 3)]
    assert jaccard_join.cluster(docs([])).count() == 0
    with pytest.raises(ValueError):
        jaccard_join.keep_one(frame.selectExpr("*", "1 AS near_tag"))


def test_keep_one_of_each_component(docs):
    rows = near_rows(9)
    frame = docs(rows, extra=True)
    kept = jaccard_join.keep_one(frame, k=3, percent=90)
    want = sorted(d for d, (_, c) in brute_components(rows, 3, 90).items() if d == c)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == want


def test_near_copies_read_small_batches(docs, monkeypatch):
    limits, real = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df: limits.append(df.sparkSession.conf.get(blocks.BATCH_LIMIT, None)) or real(df))
    frame = docs(near_rows(4))
    frame.sparkSession.conf.unset(blocks.BATCH_LIMIT)
    jaccard_join.keep_one(frame)
    assert limits[0] == str(blocks.BLOCK_BYTES) and frame.sparkSession.conf.get(blocks.BATCH_LIMIT, None) is None
    with pytest.raises(ZeroDivisionError), blocks.small_batches(frame.sparkSession):
        1 / 0
    assert frame.sparkSession.conf.get(blocks.BATCH_LIMIT, None) is None


def test_memory_of_a_prefix_task_does_not_follow_its_batch():
    """About 4 MB of text in one batch: what the task holds at once, besides the order and the powers of the hash, stays small."""
    rng = random.Random(6)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(1200)) for _ in range(500)]
    order = type("Shared", (), {"value": jaccard_join.Order(np.ones(1 << jaccard_join.SKETCH_BITS, np.uint32), np.full(1 << 16, 255, np.uint8))})
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    task = jaccard_join._prefixes(5, 80, order)
    assert sum(len(b) for b in task(iter([batch.slice(0, 9)]))) == 9 * 240
    tracemalloc.start()
    try:
        count = sum(len(b) for b in task(iter([batch])))
        assert count == 500 * 240 and tracemalloc.get_traced_memory()[1] < 12 << 20
    finally:
        tracemalloc.stop()


def test_filter_chunks_tell_once_from_twice():
    rng = np.random.default_rng(3)
    for bits in (1 << 20, 1 << 33):
        chunks = bit_filter.Chunks(bits)
        some = rng.integers(0, 1 << 62, 3000, dtype=np.uint64)
        assert chunks.add(np.concatenate([some[:2000], some[:500]])) == [] and chunks.add(some[1900:]) == []
        slots, counts = np.unique((np.concatenate([some[:2000], some[:500], some[1900:]]) % np.uint64(bits)).astype(np.int64), return_counts=True)
        once, twice = [], []
        for chunk, a, b in chunks.rows():
            for packed, found in ((a, once), (b, twice)):
                found.extend(chunk * bit_filter.CHUNK_BITS + np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))))
        assert once == slots.tolist() and twice == slots[counts > 1].tolist() and chunks.rows() == []


def counted_in_whole(hashes, bits, count, levels):
    """The filter of repeated hashes and their levels, as two tasks and one merge give them."""
    rows, repeated, sketch = {}, np.zeros(bits // 8, np.uint8), np.zeros(levels, np.uint8)
    for part in np.array_split(hashes, 2):
        task = bit_filter.Occurrences(bits, count)
        for chunk, packed in [*task.add(part), *task.rows()]:
            rows.setdefault(chunk, []).append(packed)
    for chunk, packed in rows.items():
        for whole, piece in zip((repeated, sketch), bit_filter.counted(packed, bits // levels)):
            size = len(whole) * bit_filter.CHUNK_BITS // bits
            whole[chunk * size:(chunk + 1) * size] = np.frombuffer(zlib.decompress(piece), np.uint8)
    return repeated, sketch


def test_filter_of_repeats_does_not_fill_up_with_hashes_that_occur_once():
    """As at large inputs, there are more hashes than slots: those that occur once must still be told from the others."""
    bits, rng = 1 << 20, np.random.default_rng(5)
    once, often = rng.integers(0, 1 << 64, 3 << 20, dtype=np.uint64), rng.integers(0, 1 << 64, 1000, dtype=np.uint64)
    repeated, sketch = counted_in_whole(np.concatenate([often, once, *[often] * 31]), bits, 3 << 20, bits >> 4)
    assert bit_filter.contains(repeated, often).all()
    assert bit_filter.contains(repeated, once).mean() < 0.1  # 0.95 where slots alone are compared
    assert (jaccard_join.Order(sketch, repeated).sketch[(often % np.uint64(bits)).astype(np.int64) >> 4] >= 40).all()  # 32 times


def test_packed_keys_are_read_back():
    for keys in ([], [0], [0, 0, 7, 7, 7, 1 << 20, (1 << 32) - 1]):
        keys = np.array(keys, np.uint32)
        assert bit_filter.unpacked_keys(bit_filter.packed_keys(keys)).tolist() == keys.tolist()


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_signatures_drop_members_without_a_link_and_no_link(percent):
    """Sets go to a cell only for members that signatures leave: no link is lost, and sets that share little are not sent."""
    rng, sets, family = np.random.default_rng(percent), [], []
    for number in range(12):
        base = rng.integers(0, 1 << 64, int(rng.integers(40, 700)), dtype=np.uint64)
        for changed in (0, 0.02, 0.1, 0.4, 0.9):
            new = base.copy()
            new[:int(len(base) * changed)] = rng.integers(0, 1 << 64, int(len(base) * changed), dtype=np.uint64)
            sets.append(np.unique(new[:len(new) - int(rng.integers(0, 5))]))
            family.append(number)
    n, pos, component = np.array([len(s) for s in sets]), np.zeros(len(sets), np.int64), np.arange(len(sets))
    found = jaccard_join.possible_partners(n, pos, component, [jaccard_join.signature(s) for s in sets], percent)
    overlap = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    linked = (100 * overlap >= percent * (n[:, None] + n[None, :] - overlap)) & ~np.eye(len(sets), dtype=bool)
    assert found[linked.any(1)].all() and linked.any()
    if percent >= 80:  # below, signatures of this size are too short to tell
        assert not found[4::5].any()  # nine tenths changed
        signatures, sides = [jaccard_join.signature(s) for s in sets], np.array(family) % 2
        assert not jaccard_join.possible_partners(n, pos, component, signatures, percent, sides).any()  # links stay in a family
        assert not jaccard_join.possible_partners(n, pos, np.array(family), signatures, percent).any()


def test_no_text_is_shuffled_for_the_last_step(docs):
    """However many ids go, only the texts of rows whose id passes the filter meet them."""
    frame = docs([(i, f"a{i} b c d e f g h{i}") for i in range(500)] + [(1000, "a7 b c d e f g h7"), (None, "a8 b c d e f g h8")])
    kept = jaccard_join.keep_one(frame)
    lines = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(lines) if "Join LeftAnti" in line)
    assert any("Filter" in line and "pythonUDF" in line for line in lines[joined + 1:joined + 4])
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted([i for i in range(500) if i != 8] + [0])


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


# --- strings -------------------------------------------------------------------------------

def brute_removed(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        mark = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s:s + 100] in seen:
                mark[s:s + 100] = b"\1" * 100
            seen.add(data[s:s + 100])
        rest = bytes(b for b, m in zip(data, mark) if not m)
        out[doc] = (sum(mark), sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1])), hashlib.sha256(rest).hexdigest())
    return out


def string_rows(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ñ") for _ in range(n)) for n in (99, 100, 101, 150, 400)]
    rows = []
    for i in range(40):
        parts = [rng.choice([*passages, "".join(rng.choice("abc") for _ in range(rng.randrange(1, 80)))]) for _ in range(rng.randrange(1, 6))]
        rows.append((i, "".join(parts)))
    return rows + [(100, None), (101, ""), (102, "a" * 500), (103, "ab" * 400), (104, passages[4]), (105, passages[4]), (106, "x" * 99), (107, "x" * 99), (108, "\0" * 250)]


@pytest.mark.parametrize("options", [{}, {"family_contexts": 1}, {"max_filter_bits": 0}])
def test_strings_equal_brute_force(docs, options):
    rows = string_rows(4)
    found = suffix_dedup.remove_repeats(docs(rows, extra=True), **options).collect()
    got = {r["doc_id"]: (sum(s["high"] - s["low"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept_bytes"]).hexdigest()) for r in found}
    assert got == brute_removed(rows)


def test_strings_of_repeated_rows_null_ids_and_nothing(docs):
    text = "".join(random.Random(1).choices("abcdef", k=300))
    found = suffix_dedup.remove_repeats(docs([(5, text), (5, text), (6, text), (None, text[:150])])).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["kept_bytes"]).decode()) for r in found) == [(0, text[:150]), (5, text[150:]), (5, text[150:]), (6, "")]
    assert suffix_dedup.remove_repeats(docs([])).count() == 0


def test_every_string_is_in_one_context():
    import pyarrow as pa

    texts = [*(t for _, t in string_rows(6)), "".join(random.Random(3).choices("abcdefgh ", k=20_000))]
    found = suffix_dedup.Anchors(pa.array(texts))
    found.contexts()
    starts = [s for low, high in zip(found.low.tolist(), found.high.tolist()) for s in range(low, high - 99)]
    sizes, want, at = [len((t or "").encode()) for t in texts], [], 0
    for size in sizes:
        want += range(at, at + max(0, size - 99))
        at += size
    assert starts == want  # each once: what moves and what the families hold is no multiple of the texts
    data, anchors = found.data.tobytes(), {}
    for low, high, anchor in zip(found.low.tolist(), found.high.tolist(), found.at.tolist()):
        for s in range(low, high - 99):
            assert anchors.setdefault(data[s:s + 100], anchor - s) == anchor - s and 0 <= anchor - s <= 60


def test_cut_in_many_blocks(monkeypatch):
    import pyarrow as pa

    rng, rows = random.Random(8), []
    for i in range(60):
        text = "".join(rng.choices("abé", k=rng.choice([0, 1, 30, 300])))
        size = len(text.encode())
        ends = [sorted(rng.sample(range(size + 1), 2)) for _ in range(rng.randrange(4))] if size > 1 else []
        rows.append((i, text if i % 7 else None, (ends + [[0, size]] * (i % 5 == 0 and size > 0) if i % 7 else []) or None))
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 200)
    kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    ranges = [r and [{"low": a, "high": b} for a, b in r] for _, _, r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.string()), pa.array(ranges, kind)], names=["doc_id", "text", "ranges"])
    blocks = list(suffix_dedup._cut(iter([batch.slice(0, 1), batch.slice(1)])))
    found = [r for b in blocks for r in b.to_pylist()]
    assert len(blocks) > 10 and [r["doc_id"] for r in found] == [r[0] for r in rows]
    for (_, text, ends), row in zip(rows, found):
        data = (text or "").encode()
        mark = [any(a <= i < b for a, b in ends or []) for i in range(len(data))]
        assert row["kept_bytes"] == bytes(x for x, m in zip(data, mark) if not m)
        assert [i for s in row["spans"] for i in range(s["low"], s["high"])] == [i for i, m in enumerate(mark) if m]
        assert all(a["high"] < b["low"] for a, b in zip(row["spans"], row["spans"][1:]))


def test_family_levels_stay_logarithmic():
    import numpy as np

    family, seen, rng = suffix_dedup.SuffixFamily(), set(), random.Random(2)
    for _ in range(40):
        batch = np.array([f"{rng.randrange(900):03d}".encode() for _ in range(30)], "S3")
        known = [x in seen or x in set(batch[:i]) for i, x in enumerate(batch)]
        assert family.add(batch).tolist() == known
        seen |= set(batch)
    assert len(family.levels) <= 7


@pytest.mark.parametrize("cell", [4, 512])
def test_links_inside_a_component_are_found(docs, monkeypatch, cell):
    monkeypatch.setattr(jaccard_join, "CELL_CLASSES", cell)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(12)] + [(50, " ".join([*base, "end3"])), (51, "x y z"), (52, None)]
    frame = docs(rows, extra=True)
    found = {r["doc_id"]: r["n_links"] for r in jaccard_join.link_counts(frame, k=3, percent=90).collect()}
    assert found == {**{i: 12 for i in range(12)}, 50: 12, 51: 0, 52: 0}
    if cell == 4:
        pairs, members = jaccard_join.links(frame, k=3, percent=90)
        found = [frozenset(bytes(r[c]) for c in "ab") for r in pairs.collect()]
        assert len(found) == len(set(found)) == 66  # twelve classes, each pair once
        assert sorted(r["doc_id"] for r in members.collect()) == [*range(12), 50, 51]
