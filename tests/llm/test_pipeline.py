"""The pipeline on a small table, and the registered queries against their statements."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from emberlog.llm import language_id, workload
from tests.compare import connect, differences
from tests.llm.test_text import plain_prediction


@pytest.mark.parametrize("name", sorted(workload.oracle_sql()))
def test_query_equals_its_statement(spark, sf_dir, name):
    assert differences(workload.queries()[name](spark, sf_dir), connect(sf_dir), workload.oracle_sql()[name]) is None


def test_stages_take_effect(spark, docs):
    base = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base + " end", "en", "b"), (4, "123 456", "en", "a"), (5, None, None, None), (6, "quite another text with words of its own", "en", "b")]
    frame, seen = docs(rows), []
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "")
        seen.append(sorted(set(r["doc_id"] for r in frame.collect())))
        if name != "bpe":
            assert frame.columns == docs(rows).columns
    assert seen[:3] == [[1, 2, 3, 6], [2, 3, 6], [2, 6]] and set(seen[4]) == set(seen[3]) <= {2, 6}
    assert all(r["round_trip"] for r in frame.collect())


def test_stages_of_an_empty_table(spark, docs):
    frame = docs([])
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "")
    assert frame.count() == 0


def near_copies_kept(rows) -> set[int]:
    """All pairs by their five-word shingles, their components, the smallest id of each."""
    sets = {}
    for r in rows:
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    reach = {i: i for i in sets}

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root(a), root(b)))
            reach[high] = low
    return {root(i) for i in sets}


def language_kept(rows) -> set[int]:
    counts = defaultdict(Counter)
    for r in rows:
        if r["text"] is not None and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            counts[r["lang"]].update(language_id.words_of(r["text"]))
    found = {r["doc_id"]: plain_prediction(counts, r["text"]) for r in rows}
    return {i for i, (label, score) in found.items() if label != "und" and score >= 0.5}


def copies_kept(rows) -> set[int]:
    last = {}
    for r in rows:
        last[r["text"] or ""] = max(r["doc_id"], last.get(r["text"] or "", -1))
    return set(last.values())


def test_each_stage_equals_brute_force_on_its_own_input(spark, sf_dir, tmp_path):
    """Every stage on the whole small table: kept ids, copies taken and tokens, compared exactly."""
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = frame.collect()
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        frame = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        after = stage(spark, frame, sf_dir)
        after.write.parquet(f"{tmp_path}/{name}/out")
        after = spark.read.parquet(f"{tmp_path}/{name}/out")
        found = after.collect()
        if name in ("language_id", "exact_dedup", "near_dedup"):
            want = {"language_id": language_kept, "exact_dedup": copies_kept, "near_dedup": near_copies_kept}[name](before)
            assert sorted(r["doc_id"] for r in found) == sorted(want), name
            assert {r["doc_id"]: r for r in found} == {r["doc_id"]: r for r in before if r["doc_id"] in want}
        elif name == "mix":
            con = duckdb.connect()
            con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/{name}/documents.parquet/*.parquet'")
            cursor = con.execute(workload.oracle_sql()["op8_fair_mix"])
            at = {d[0]: i for i, d in enumerate(cursor.description)}
            want = {r[at["doc_id"]]: r[at["taken"]] // r[at["size"]] for r in cursor.fetchall() if r[at["taken"]]}
            assert dict(Counter(r["doc_id"] for r in found)) == want
        else:
            library = Tokenizer.from_file(workload.vocabulary_path())
            want = [(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids) for r in before]
            assert sorted((r["doc_id"], np.frombuffer(r["token_ids"], "<u4").tolist()) for r in found) == sorted(want)
            assert all(r["round_trip"] for r in found)
        frame = after


def test_stages_of_awkward_rows(spark, docs):
    """Nulls in every column, repeated rows, equal ids, empty and very long texts pass through all stages."""
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (1, text + " other", "en", "b"), (None, text, "en", None), (2, None, None, None), (None, None, None, None), (3, "", "en", "a"), (4, "½ 12", "en", "a"),
            (5, "quite another text of its own " * 20_000, "en", "b"), (6, "some words that stand alone here", None, "b")]
    frame = docs(rows).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "")
    ids = {r["doc_id"] for r in frame.collect()}
    assert {5, 6} & ids and not {2, 3, 4} & ids


def test_pipeline_runs_over_the_table(spark, sf_dir):
    total = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    out = corpus_pipeline.run(spark, sf_dir)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert 0.5 * total < len(set(ids)) <= total and max(map(ids.count, set(ids))) <= 2
