"""Operators against brute force on small rows, including hot keys, ties, nulls and empty inputs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.operators import joins, ordered, rows, scopes
from emberlog.session import stored


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


@pytest.fixture(scope="module")
def readings():
    """One key holds a third of all rows; times repeat."""
    rng = random.Random(7)
    keys = ["hot"] * 200 + [f"k{rng.randrange(40)}" for _ in range(400)]
    return [(i, key, rng.randrange(90), rng.choice([None, *range(5)])) for i, key in enumerate(keys)]


def test_running_equals_loop(spark, readings):
    df = table(spark, readings, "id INT, key STRING, at INT, x INT")
    got = ordered.running(df, ["key"], [F.col("at").asc(), F.col("id").asc()], {
        "n": ("count", None), "total": ("sum", "x"), "low": ("min", "x"), "high": ("max", "x"), "last": ("last", "x"), "before": ("prev", "x"),
        "place": ("row", None), "size": ("total", None), "sum_all": ("total", "x")}, parts=5)
    want = []
    for key in {r[1] for r in readings}:
        own = sorted((r for r in readings if r[1] == key), key=lambda r: (r[2], r[0]))
        for i, row in enumerate(own):
            seen = [r[3] for r in own[: i + 1] if r[3] is not None]
            known = [r[3] for r in own if r[3] is not None]
            want.append((row[0], i + 1, sum(seen) if seen else None, min(seen, default=None), max(seen, default=None), seen[-1] if seen else None,
                         own[i - 1][3] if i else None, i + 1, len(own), sum(known) if known else None))
    assert collected(got, "id", "n", "total", "low", "high", "last", "before", "place", "size", "sum_all") == sorted(want, key=repr)


def test_exact_quantiles(spark, readings):
    import statistics

    df = table(spark, readings, "id INT, key STRING, at INT, x INT")
    got = {r.key: r.m for r in ordered.exact_quantiles(df, ["key"], "at", {"m": 0.5}, parts=4).collect()}
    for key, value in got.items():
        assert value == statistics.median(r[2] for r in readings if r[1] == key)
    assert ordered.exact_quantiles(df.limit(0), [], "at", {"m": 0.5}).first().m is None


@pytest.mark.parametrize("base_bits", [0, 3, 20])
def test_interval_join_equals_range_join(spark, readings, base_bits):
    rng = random.Random(3)
    spans = [(f"k{rng.randrange(40)}" if i % 3 else "hot", i, rng.randrange(80), 0) for i in range(90)]
    spans = [(k, i, a, a + rng.choice([0, 3, 20, 500, 1 << 40]) - (5 if i == 4 else 0)) for k, i, a, _ in spans]
    events = table(spark, [(r[0], r[1], r[2]) for r in readings], "id INT, key STRING, at BIGINT")
    intervals = table(spark, spans, "key STRING, span INT, s BIGINT, e BIGINT")
    got = joins.interval_join(events, intervals, ["key"], "at", "s", "e", ["span"], base_bits=base_bits)
    want = []
    for i, key, at, _ in readings:
        hits = [s for k, s, a, b in spans if k == key and a <= at <= b]
        want += [(i, s) for s in hits] or [(i, None)]
    assert collected(got, "id", "span") == sorted(want, key=repr)


def test_interval_join_edges(spark):
    events = table(spark, [(1, "a", -5), (2, "a", None), (3, None, 4), (4, "b", 4), (5, "a", 11), (6, "a", 10), (6, "a", 10)], "id INT, key STRING, at BIGINT")
    spans = table(spark, [("a", 1, -9, -5), ("a", 2, 10, 10), ("a", 3, 10, 10), ("a", 4, 9, 3), ("a", 5, None, 3), (None, 6, 0, 9)], "key STRING, span INT, s BIGINT, e BIGINT")
    got = joins.interval_join(events, spans, ["key"], "at", "s", "e", ["span"], base_bits=1)
    assert collected(got, "id", "span") == sorted([(1, 1), (2, None), (3, None), (4, None), (5, None), *[(6, 2), (6, 3)] * 2], key=repr)
    none = joins.interval_join(events, spans.limit(0), ["key"], "at", "s", "e", ["span"])
    assert collected(none, "id", "span") == sorted([(i, None) for i in (1, 2, 3, 4, 5, 6, 6)], key=repr)
    assert joins.interval_join(events.limit(0), spans, ["key"], "at", "s", "e", ["span"]).count() == 0


def test_interval_join_reads_events_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "'a' AS key", "id AS at").write.parquet(f"{tmp_path}/events")
    spans = table(spark, [("a", 1, 0, 10)], "key STRING, span INT, s BIGINT, e BIGINT")
    plan = joins.interval_join(spark.read.parquet(f"{tmp_path}/events"), spans, ["key"], "at", "s", "e", ["span"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("id#") and sum(line.strip(" +-:").startswith("Relation [id#") for line in plan.splitlines()) == 1


@pytest.mark.parametrize("hot_rows", [5, 1000])
def test_asof_equals_loop(spark, readings, hot_rows):
    left = [(r[0], r[1], r[2], r[0] % 4) for r in readings if r[0] % 2]
    right = [(r[1], r[2], r[0] % 5) for r in readings if not r[0] % 2]
    got = joins.asof_last(table(spark, left, "id INT, key STRING, at BIGINT, part INT"), table(spark, right, "key STRING, mark BIGINT, part INT"), ["key"], "at", "mark", "found",
                          ["part"], "own", hot_rows=hot_rows)
    want = [(i, max((m for k, m, _ in right if k == key and m <= at), default=None), max((m for k, m, p in right if k == key and m <= at and p == part), default=None)) for i, key, at, part in left]
    assert collected(got, "id", "found", "own") == sorted(want, key=repr)
    plain = joins.asof_last(table(spark, left, "id INT, key STRING, at BIGINT, part INT"), table(spark, right, "key STRING, mark BIGINT, part INT"), ["key"], "at", "mark", "found", hot_rows=hot_rows)
    assert collected(plain, "id", "found") == sorted([w[:2] for w in want], key=repr)


def test_resolve_interval_id_keeps_given_ids(spark):
    events = table(spark, [(1, "a", 7, 5), (2, "a", None, 5), (3, "a", None, 99)], "id INT, key STRING, own BIGINT, at BIGINT")
    spans = table(spark, [("a", 1, 0, 10)], "key STRING, span BIGINT, s BIGINT, e BIGINT")
    got = joins.resolve_interval_id(events, spans, ["key"], "own", "span", "at", "s", "e")
    assert collected(got, "id", "span") == [(1, 7), (2, 1), (3, None)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_hot_join_equals_join(spark, readings, how):
    df = table(spark, [(r[0], r[1]) for r in readings], "id INT, key STRING")
    dim = table(spark, [("hot", 1), ("k1", 2), ("k2", 3)], "key STRING, v INT")
    got = collected(joins.split_hot_join(df, dim, ["key"], how, share=0.05), "id", "key", "v")
    assert got == collected(df.join(dim, "key", how), "id", "key", "v")


def test_split_hot_join_with_null_and_repeated_keys(spark):
    df = table(spark, [(i, None if i % 2 else "hot") for i in range(40)], "id INT, key STRING")
    dim = table(spark, [("hot", 1), (None, 5)], "key STRING, v INT")
    assert collected(joins.split_hot_join(df, dim, ["key"]), "id", "v") == sorted([(i, None if i % 2 else 1) for i in range(40)], key=repr)
    with pytest.raises(Exception, match="repeats a hot key"):
        joins.split_hot_join(df, dim.unionByName(dim), ["key"]).collect()


def test_latest_top_mode_are_unique_and_ordered(spark, readings):
    df = table(spark, readings, "id INT, key STRING, at INT, x INT")
    latest = rows.latest_by(df, ["key"], ["at", "id"]).collect()
    assert len({r.key for r in latest}) == len(latest)
    for r in latest:
        assert (r.at, r.id) == max((q[2], q[0]) for q in readings if q[1] == r.key)
    top = rows.top_n_by(df, ["key"], ["at", "id"], 3).groupBy("key").count().collect()
    assert all(r["count"] <= 3 for r in top)
    for r in rows.mode_by(df, ["key"], "x", "value", "n").collect():
        own = [q[3] for q in readings if q[1] == r.key and q[3] is not None]
        best = max(own.count(x) for x in own)
        assert (r.value, r.n) == (min(x for x in own if own.count(x) == best), best)


def test_latest_limits_before_the_shuffle(spark, readings):
    """The plan must cut rows per key on the map side; a hot key then costs one row per task."""
    df = stored(table(spark, readings, "id INT, key STRING, at INT, x INT"))
    plan = rows.latest_by(df, ["key"], ["at", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_counts_and_total_order(spark):
    df = table(spark, [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q")], "key STRING, n INT, t STRING")
    got = rows.dedup_ordered(df, ["key"], ["n"], count_as="copies")
    assert collected(got) == [("a", 2, "z", 3), ("b", None, "q", 1)]
    assert collected(rows.with_duplicate_count(df, ["key"], "c"), "key", "c") == [("a", 3), ("a", 3), ("a", 3), ("b", 1)]


def test_copies_round_trip(spark):
    data = [("a", 1)] * 25 + [("b", None)] * 3 + [("c", 2)]
    df = table(spark, data, "k STRING, n INT")
    grown = rows.expand_copies(rows.collapse_copies(df), chunk=4)
    assert collected(grown, "k", "n") == sorted(data, key=repr)
    assert sorted(r._copy for r in grown.filter("k = 'a'").collect()) == list(range(25))


def test_prefer_flagged(spark):
    df = table(spark, [("a", 1), ("a", 2), ("b", 1), ("b", 3)], "k STRING, n INT")
    assert collected(rows.prefer_flagged(df, ["k"], F.col("n") == 2)) == [("a", 2), ("b", 1), ("b", 3)]


def test_first_source_wins(spark):
    a = table(spark, [("Ann", 1)], "name STRING, n INT")
    b = table(spark, [("ann", 2), ("Bob", 3)], "name STRING, n INT")
    got = rows.first_source_wins([a, b], [F.lower("name")])
    assert collected(got, "name", "n") == [("Ann", 1), ("Bob", 3)]


def test_rollup_all_equals_sum_of_parts(spark, readings):
    df = table(spark, readings, "id INT, key STRING, at INT, x INT").groupBy("key", "at").agg(F.count("*").alias("n"))
    df = df.withColumn("who", F.lit("w"))
    rolled = scopes.scope_rollup(df.withColumn("at", F.col("at").cast("string")), ["who"], ["key", "at"], [("key", "at"), ("key",), ()], {"n": F.sum("n")}, labels=["key", "at"])
    whole = rolled.filter("key = 'All' AND at = 'All'").first().n
    assert whole == len(readings) == rolled.filter("key <> 'All' AND at = 'All'").agg(F.sum("n")).first()[0]


def test_union_equals_full_outer(spark):
    a = table(spark, [("x", 1, 10), ("y", None, 20)], "k STRING, d INT, a INT")
    b = table(spark, [("x", 1, 5), ("z", 2, 7)], "k STRING, d INT, b INT")
    got = scopes.combine_sources([a, b], ["k", "d"], {"a": F.sum("a"), "b": F.sum("b")})
    on = a.k.eqNullSafe(b.k) & a.d.eqNullSafe(b.d)
    want = a.join(b, on, "full").select(F.coalesce(a.k, b.k), F.coalesce(a.d, b.d), "a", "b")
    assert collected(got) == collected(want)


def test_stored_keeps_rows_and_schema(spark):
    df = table(spark, [(1, ["a"], None)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("l", T.ArrayType(T.StringType())), T.StructField("n", T.StringType())]))
    assert collected(stored(df)) == collected(df)


def test_hot_key_spreads_over_slices(spark, readings, monkeypatch):
    """The stored slices cut the hot key, so no task orders all of its rows."""
    kept = []

    def keep(df):
        kept.append(stored(df))
        return kept[-1]

    monkeypatch.setattr(ordered, "stored", keep)
    df = table(spark, readings, "id INT, key STRING, at INT, x INT")
    ordered.running(df, ["key"], [F.col("at").asc(), F.col("id").asc()], {"n": ("row", None)}, parts=6).count()
    slices = kept[0].filter("key = 'hot'").groupBy("_slice").count().collect()
    assert len(slices) > 1 and max(r["count"] for r in slices) < 200
