"""Column functions on edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import names as nm
from emberlog.functions import values as v
from emberlog.plans.gold_readiness import required_weapon
from emberlog.plans.views import main_role


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(x).alias(n) for n, x in values.items()]) if values else spark.range(1)
    return row.select(column.alias("r")).first().r


@pytest.mark.parametrize("name,want", [("  Light's   Potential ", "lights potential"), (None, ""), ("A\tB", "a b")])
def test_normalize(spark, name, want):
    assert one(spark, nm.normalize_name(F.lit(name).cast("string"))) == want


def test_classify_and_join(spark):
    arr = F.array(*[F.lit(n) for n in ("Well Fed", "Royal Roast", "Shiny", "Hearty Feast", "")])
    assert one(spark, nm.join_names(nm.classify_names(arr, rules.FOOD_NAMES, rules.FOOD_KEYWORDS))) == "Well Fed | Royal Roast | Hearty Feast"
    assert one(spark, nm.join_names(nm.classify_names(arr, ("none",)))) is None


def test_merge_names(spark):
    assert one(spark, nm.merge_name_columns(F.lit("A | B"), F.lit("B |  | C "))) == "A | B | C"
    assert one(spark, nm.merge_name_columns(F.lit(None).cast("string"), F.lit(" "))) is None


@pytest.mark.parametrize("realm,want", [("Argent Dawn", "argent-dawn"), ("Quel'Thalas", "quel-thalas"), ("a_b", "a-b"), ("", "home"), (None, "home"), ("TwistingNether", "fixed")])
def test_realm_slug(spark, realm, want):
    assert one(spark, nm.realm_slug(F.lit(realm).cast("string"), "home", {"twistingnether": "fixed"})) == want


@pytest.mark.parametrize("text,query,want", [("Élodie", "elo", True), ("Thunderfury", "thufy", True), ("Thunderfury", "tfy", False), ("abc", "", True), (None, "x", False),
                                             ("abcdefg", "abcgf", False)])
def test_loose_match(spark, text, query, want):
    assert one(spark, nm.loose_match(F.lit(text).cast("string"), query)) is want


def test_identity_key(spark):
    assert one(spark, nm.identity_key(F.lit(" Ann "), F.lit(None).cast("string"), F.lit("X"))) == "ann:unknown:x"


def test_ratio_and_missing_array_elements_do_not_raise(spark):
    assert one(spark, v.ratio(F.lit(3), F.lit(0))) == 3.0
    assert one(spark, v.first_where(F.array().cast("array<int>"), lambda x: x > 1)) is None
    assert one(spark, v.rank_percentile(F.lit(1), F.lit(1))) == 100.0
    assert one(spark, v.mm_ss(F.lit(307))) == "5m 07s"


@pytest.mark.parametrize("source,clear,par,up,want", [("best", None, None, None, True), ("recent", 5, 5, 0, True), ("recent", 6, 5, 1, True), ("recent", 6, None, 0, False), ("recent", None, None, None, False)])
def test_timed_run(spark, source, clear, par, up, want):
    cast = lambda x: F.lit(x).cast("bigint")
    assert one(spark, v.timed_run(F.lit(source), cast(clear), cast(par), cast(up))) is want


@pytest.mark.parametrize("day,want", [("2024-01-03", "2024-01-03"), ("2024-01-02", "2023-12-27"), ("2024-01-09", "2024-01-03")])
def test_reset_week(spark, day, want):
    assert str(one(spark, v.reset_week_start(F.lit(day).cast("date")))) == want


@pytest.mark.parametrize("cls,spec,names,has,want", [
    ("Shaman", "Enhancement", "Flametongue Weapon | Windfury Weapon", True, True), ("Shaman", "Enhancement", "Windfury Weapon", True, False),
    ("Shaman", "Restoration", None, True, False), ("Shaman", "Restoration", "Earthliving Weapon", False, True), ("Shaman", "Elemental", None, True, True),
    ("Shaman", None, "Windfury Weapon", False, True), ("Mage", "Frost", None, True, True), ("Mage", "Frost", "x", None, False)])
def test_required_weapon(spark, cls, spec, names, has, want):
    df = spark.createDataFrame([(cls, spec, names, has)], "c STRING, s STRING, n STRING, h BOOLEAN")
    assert df.select(required_weapon("c", "s", "n", "h").alias("r")).first().r is want


@pytest.mark.parametrize("d,h,t,want", [(1.0, 1.0, 0.0, "healer"), (1.0, 0.0, 1.0, "tank"), (2.0, 1.0, 1.0, "dps"), (0.0, 0.0, 0.0, "dps"), (None, None, None, "dps")])
def test_main_role(spark, d, h, t, want):
    df = spark.createDataFrame([(d, h, t)], "score_dps DOUBLE, score_healer DOUBLE, score_tank DOUBLE")
    assert df.select(main_role().alias("r")).first().r == want


def test_rule_table():
    assert len(rules.COOLDOWN_RULES) == 57
    assert len({r.ability_id for r in rules.COOLDOWN_RULES}) == 57
    charged = {r.ability_name for r in rules.COOLDOWN_RULES if r.max_charges == 2}
    assert charged == {r.ability_name for r in rules.COOLDOWN_RULES if r.capacity_model == "charge_based"}
    assert [r.ability_name for r in rules.COOLDOWN_RULES if not r.capacity_score_eligible] == ["Metamorphosis"]


def test_hash_keys_have_known_values(spark):
    """Each column's hash seeds the next, from 42 on; whole numbers as eight bytes, nulls leave the seed as it is."""
    import struct

    import xxhash

    def plain(*values):
        seed = 42
        for value in values:
            if value is not None:
                seed = xxhash.xxh64_intdigest(value.encode() if isinstance(value, str) else struct.pack("<q", value), seed=seed)
        return seed - (1 << 64) if seed >> 63 else seed

    rows = [("R", 1, "Ann", 5, None), ("", 0, None, -1, "Blow"), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "report_code STRING, fight_id BIGINT, player_name STRING, at BIGINT, blow STRING")
    found = frame.select(F.xxhash64("report_code", "fight_id", "player_name", "at", "blow").alias("h")).collect()
    assert [r.h for r in found] == [plain(*row) for row in rows]


def test_mean_is_exact_or_plain(spark):
    frame = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, 0.3), (1, None), (2, 1e20), (2, 2e20), (3, 1 / 3), (3, 2 / 3), (4, None), (5, 9e23), (5, 9e23)], "k INT, x DOUBLE")
    found = {r.k: r.m for r in frame.groupBy("k").agg(v.mean("x").alias("m")).collect()}
    assert found == {1: 0.6 / 3, 2: 1.5e20, 3: 0.5, 4: None, 5: 9e23}
    assert spark.range(5).agg(v.mean("id").alias("m")).first().m == 2.0
