"""The report domain derived from the ``events`` table, as SQL both Spark and DuckDB run.

A report is one day of one guild of fifty users, so the number of reports, pulls and players grows
with the table and every list kept inside a row (pull members, roster sheet) stays bounded.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import rules

DIALECTS = {
    "spark": {"K": "CAST(get_json_object(props, '$.k') AS BIGINT)", "MS": "unix_millis(CAST(ts AS TIMESTAMP))"},
    "duckdb": {"K": "CAST(json_extract_string(props, '$.k') AS BIGINT)", "MS": "epoch_us(ts) // 1000"},
}


def name_of(user: str) -> str:
    return f"CONCAT(CHR(CAST(65 + ({user}) % 26 AS INT)), 'ar', CAST({user} AS STRING))"


# Two specs per class, in class order from 0.
_CLASS_SPECS = (("Warrior", 71, 73), ("Paladin", 65, 66), ("Hunter", 253, 254), ("Rogue", 259, 260), ("Priest", 256, 258),
                ("DeathKnight", 250, 251), ("Shaman", 262, 264), ("Mage", 62, 63), ("Warlock", 265, 266), ("Monk", 269, 270),
                ("Druid", 104, 105), ("DemonHunter", 577, 581), ("Evoker", 1467, 1468))


def _values(rows, columns: str) -> str:
    def literal(x):
        return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(literal(x) for x in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def _numbered_rules():
    seen: dict[str, int] = {}
    numbered = []
    for r in rules.COOLDOWN_RULES:
        numbered.append((*r, seen.get(r.player_class, 0)))
        seen[r.player_class] = seen.get(r.player_class, 0) + 1
    return [(*row, seen[row[1]]) for row in numbered]


CTES: dict[str, str] = {
    "classes": _values([(i, *c) for i, c in enumerate(_CLASS_SPECS)], "class_no, player_class, spec_a, spec_b"),
    "rules": _values(_numbered_rules(),
                     "cooldown_category, player_class, ability_id, ability_name, cooldown_seconds, active_seconds, allowed_spec_ids, "
                     "required_talent_spell_ids, capacity_model, max_charges, capacity_score_eligible, rule_no, n_rules"),
    "ev": """SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, CAST(ROUND(value * 100) AS BIGINT) AS cents, {K} AS k,
        CAST(ts AS DATE) AS d, {MS} AS ms, CAST(FLOOR(user_id / 50) AS BIGINT) AS g FROM events""",
    "e": f"""SELECT ev.*, CAST(FLOOR((ms % 86400000) / 40) AS BIGINT) AS rel_ms,
        CAST(FLOOR((ms % 86400000) / 14400000) AS BIGINT) + 1 AS fight_id,
        CONCAT(CAST(d AS STRING), '-G', CAST(g AS STRING)) AS report_code, CAST(EXTRACT(DAY FROM d) AS BIGINT) AS dom,
        {name_of('user_id')} AS player_name, c.player_class, c.spec_a, c.spec_b,
        CASE WHEN user_id % 5 = 0 THEN NULL ELSE CONCAT('Realm', CAST(user_id % 5 AS STRING)) END AS realm,
        CONCAT('realm-', CAST(user_id % 5 AS STRING)) AS realm_slug,
        CONCAT(CAST(d AS STRING), 'T00:00:00') AS _ingested_at
        FROM ev JOIN classes c ON ev.user_id % 13 = c.class_no""",
    "reports": """SELECT report_code AS code, CONCAT('Night ', report_code) AS title,
        date_trunc('millisecond', MIN(ts)) AS start_time_utc, date_trunc('millisecond', MAX(ts)) AS end_time_utc,
        MIN(ms) AS start_ms, MAX(ms) AS end_ms,
        MAX(dom % 4) AS zone_id, CASE WHEN MAX(dom % 4) = 0 THEN 'Blackrock Depths' ELSE CONCAT('ZONE_', CAST(MAX(dom % 4) AS STRING)) END AS zone_name,
        MAX(_ingested_at) AS _ingested_at, 'events' AS _source, MAX(d) AS raid_night_date FROM e GROUP BY report_code""",
    "pulls": """SELECT report_code, fight_id, MAX(d) AS raid_night_date, MAX(dom) AS dom,
        SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) % 3 = 0 AS is_kill, MIN(rel_ms) AS fight_start_ms, MAX(rel_ms) AS fight_end_ms,
        CAST(FLOOR((MAX(rel_ms) - MIN(rel_ms)) / 1000) AS INT) AS duration_seconds, CAST(MIN(cents) % 10000 AS DOUBLE) / 100 AS boss_percentage,
        1 + COUNT(*) % 4 AS last_phase, MAX(_ingested_at) AS _ingested_at FROM e GROUP BY report_code, fight_id""",
    "fights": """SELECT p.report_code, r.title AS report_title, p.fight_id,
        CONCAT('Boss ', CAST(10 * r.zone_id + p.fight_id % 3 + 1 AS STRING)) AS boss_name, 10 * r.zone_id + p.fight_id % 3 + 1 AS encounter_id,
        p.is_kill, 3 + (p.dom + p.fight_id) % 3 AS difficulty, p.fight_start_ms, p.duration_seconds, p.boss_percentage, p.last_phase,
        CAST(20 AS BIGINT) AS fight_size, p._ingested_at,
        CASE (p.dom + p.fight_id) % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Heroic' ELSE 'Mythic' END AS difficulty_label,
        CASE WHEN p.is_kill THEN 'kill' ELSE 'wipe' END AS outcome, r.zone_id, r.zone_name, r.start_time_utc, p.raid_night_date,
        p.fight_end_ms FROM pulls p JOIN reports r ON p.report_code = r.code""",
    "fight_players": "SELECT DISTINCT report_code, fight_id, user_id FROM e",
    "actors": "SELECT DISTINCT report_code, user_id AS actor_id, player_name, player_class, realm, _ingested_at FROM e",
    "attendance": """SELECT e.report_code, e.player_name, CAST(1 + MAX(k) % 4 AS INT) AS presence, MAX(e.player_class) AS player_class,
        MAX(e._ingested_at) AS _ingested_at, CASE WHEN MAX(k) % 4 = 0 THEN 'present' WHEN MAX(k) % 4 = 1 THEN 'benched' ELSE 'absent' END AS presence_status,
        MAX(r.zone_id) AS zone_id, MAX(r.zone_name) AS zone_name, MAX(r.start_time_utc) AS report_start_utc, MAX(r.raid_night_date) AS raid_night_date
        FROM e JOIN reports r ON e.report_code = r.code GROUP BY e.report_code, e.player_name""",
    "bought": """SELECT * FROM (SELECT e.*, ROW_NUMBER() OVER (PARTITION BY report_code, fight_id, user_id ORDER BY event_id DESC) AS rn
        FROM e WHERE event_type = 'purchase') t WHERE rn = 1""",
    "perf": """SELECT b.report_code, b.fight_id, f.boss_name, f.encounter_id, f.difficulty, f.difficulty_label, f.zone_id, f.zone_name,
        CAST(f.duration_seconds AS BIGINT) * 1000 AS duration_ms, CASE b.k % 3 WHEN 0 THEN 'healer' WHEN 1 THEN 'dps' ELSE 'tank' END AS role,
        b.user_id AS actor_id, b.player_name, b.player_class,
        CASE b.k % 3 WHEN 0 THEN 'Restoration' WHEN 1 THEN 'Enhancement' ELSE 'Elemental' END AS spec,
        600 + CAST(b.k AS DOUBLE) / 2 AS avg_item_level, b.k % 2 AS potion_use, CAST((b.k + 1) % 2 AS BIGINT) AS healthstone_use,
        b.k % 4 < 2 AS has_weapon_enhancement,
        CASE b.k % 4 WHEN 0 THEN 'Oil of Dawn' WHEN 1 THEN 'Flametongue Weapon' END AS weapon_enhancement_names,
        b.k * 3 AS crit_rating, b.k * 4 AS haste_rating, b.k * 5 AS mastery_rating, b.k * 6 AS versatility_rating, b._ingested_at
        FROM bought b JOIN fights f ON b.report_code = f.report_code AND b.fight_id = f.fight_id""",
    "rankings": """SELECT report_code, fight_id, CASE k % 3 WHEN 0 THEN 'healer' WHEN 1 THEN 'dps' ELSE 'tank' END AS role, player_name,
        player_class, CASE k % 3 WHEN 0 THEN 'Restoration' WHEN 1 THEN 'Enhancement' ELSE 'Elemental' END AS spec,
        CAST(cents AS DOUBLE) + 0.5 AS amount, CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS rank_percent,
        CAST(99 - k AS DOUBLE) AS bracket_percent, CONCAT('~', CAST(k * 10 AS STRING)) AS rank_string, k + 100 AS total_parses, _ingested_at
        FROM bought""",
    "deaths": """SELECT event_id, report_code, fight_id, player_name, player_class, rel_ms AS death_timestamp_ms, cents AS overkill, _ingested_at,
        CASE WHEN k % 12 = 0 THEN NULL ELSE CONCAT('Blow ', CAST(k % 12 AS STRING)) END AS killing_blow_name,
        CASE WHEN k % 12 = 0 THEN NULL ELSE k % 12 END AS killing_blow_id FROM e WHERE event_type = 'error'""",
    "raw_casts": """SELECT e.event_id, e.report_code, CASE WHEN e.k % 4 = 0 THEN NULL ELSE e.fight_id END AS event_fight_id,
        e.rel_ms + CASE WHEN e.k % 8 = 0 THEN 3000 ELSE 0 END AS cast_timestamp_ms, e.user_id AS actor_id,
        CAST(CASE WHEN e.k % 10 = 0 THEN 6262 WHEN e.k % 10 = 1 THEN 1234768 WHEN e.k % 10 = 2 THEN 431416 WHEN e.k % 10 = 3 THEN 900000 + e.k
        ELSE r.ability_id END AS BIGINT) AS ability_id, e._ingested_at
        FROM e JOIN rules r ON e.player_class = r.player_class AND e.k % r.n_rules = r.rule_no WHERE e.event_type IN ('click', 'view')""",
    "combatants": """SELECT e.event_id, e.report_code, CASE WHEN e.k % 4 = 0 THEN NULL ELSE e.fight_id END AS event_fight_id,
        e.rel_ms AS combatant_timestamp_ms, e.user_id AS actor_id,
        CAST(CASE WHEN e.k % 5 = 0 THEN NULL WHEN e.k % 2 = 0 THEN e.spec_a ELSE e.spec_b END AS BIGINT) AS spec_id,
        CASE e.k % 6 WHEN 0 THEN 'Well Fed' WHEN 1 THEN 'Flask of the Magisters' WHEN 2 THEN 'Thalassian Phoenix Oil' WHEN 3 THEN 'Royal Roast'
        WHEN 4 THEN 'Haranir Phial of Finesse' ELSE 'Plain Aura' END AS aura_name, CAST(r.ability_id AS BIGINT) AS talent_id, e._ingested_at
        FROM e JOIN rules r ON e.player_class = r.player_class AND e.k % r.n_rules = r.rule_no WHERE e.event_type = 'signup'""",
    "buff_events": """SELECT event_id, report_code, fight_id, rel_ms AS timestamp_ms, user_id AS actor_id,
        CASE k % 7 WHEN 0 THEN 'Light''s Potential' WHEN 1 THEN 'Potion of Recklessness' ELSE 'Plain Buff' END AS ability_name,
        CASE k % 7 WHEN 0 THEN CAST(1236616 AS BIGINT) WHEN 2 THEN CAST(1237154 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS ability_id
        FROM e WHERE event_type = 'signup'""",
    "users": f"""SELECT DISTINCT user_id, {name_of('user_id')} AS own_name FROM events""",
    "members": f"""SELECT u.user_id, CASE WHEN u.user_id % 2 = 0 THEN UPPER(u.own_name) ELSE u.own_name END AS name,
        CONCAT('realm-', CAST(u.user_id % 5 AS STRING)) AS realm_slug, u.user_id % 11 AS rank, u.user_id % 13 + 1 AS class_id,
        CAST(80 AS BIGINT) AS level, '2024-02-01T00:00:00' AS _ingested_at FROM users u WHERE u.user_id % 4 <> 3""",
    "labelled_members": """SELECT name, realm_slug, rank, CASE rank WHEN 0 THEN 'Guild Master' WHEN 1 THEN 'GM Alt' WHEN 2 THEN 'Officer'
        WHEN 3 THEN 'Officer Alt' WHEN 4 THEN 'Officer Alt' WHEN 5 THEN 'Raider' WHEN 6 THEN 'Raider Alt' WHEN 7 THEN 'Bestie' WHEN 8 THEN 'Trial'
        WHEN 9 THEN 'Social' ELSE CONCAT('Rank ', CAST(rank AS STRING)) END AS rank_label,
        CASE WHEN rank <= 1 THEN 'GM' WHEN rank <= 4 THEN 'Officer' WHEN rank = 5 THEN 'Raider' WHEN rank = 6 THEN 'Raider Alt' WHEN rank = 7
        THEN 'Bestie' WHEN rank = 8 THEN 'Trial' ELSE 'Social' END AS rank_category, rank <= 5 OR rank = 8 AS is_raid_team, class_id,
        CASE class_id WHEN 1 THEN 'Warrior' WHEN 2 THEN 'Paladin' WHEN 3 THEN 'Hunter' WHEN 4 THEN 'Rogue' WHEN 5 THEN 'Priest' WHEN 6 THEN
        'Death Knight' WHEN 7 THEN 'Shaman' WHEN 8 THEN 'Mage' WHEN 9 THEN 'Warlock' WHEN 10 THEN 'Monk' WHEN 11 THEN 'Druid' WHEN 12 THEN
        'Demon Hunter' WHEN 13 THEN 'Evoker' END AS class_name, level, _ingested_at FROM members""",
    "overrides": f"""SELECT CONCAT('o', CAST(user_id AS STRING)) AS id, CASE WHEN user_id % 30 = 1 THEN 'replace' ELSE 'pool' END AS mode,
        CASE WHEN user_id % 30 = 1 THEN {name_of('user_id')} END AS source_character, CASE WHEN user_id % 30 = 1 THEN {name_of('user_id + 1')} END AS target_character,
        CASE WHEN user_id % 30 = 1 THEN NULL ELSE CONCAT({name_of('user_id')}, '|', {name_of('user_id + 3')}) END AS characters,
        CASE WHEN user_id % 30 = 1 THEN '' ELSE CONCAT('Pool ', CAST(user_id AS STRING)) END AS display_name,
        CASE WHEN user_id % 60 = 1 THEN NULL ELSE user_id % 60 <> 31 END AS enabled, '' AS notes, 'admin' AS updated_by,
        '2024-02-01T00:00:00' AS updated_at FROM users WHERE user_id % 30 IN (1, 5)""",
    "live_roster": """SELECT name, 'Raider' AS roster_rank, class_name AS player_class, CONCAT('Race ', CAST(class_id AS STRING)) AS race,
        CASE WHEN class_id % 2 = 0 THEN CONCAT('late, ', CHR(34), 'often', CHR(34), CHR(10), 'or not') ELSE '' END AS note, '2024-02-01 08:00' AS source_refreshed_at
        FROM labelled_members WHERE rank <= 5""",
    "zones": """SELECT DISTINCT zone_id, zone_name, zone_id = 0 AS zone_frozen, encounter_id, boss_name AS encounter_name,
        '2024-02-01T00:00:00' AS _ingested_at FROM fights""",
    "runs": """SELECT player_name, realm_slug, 'eu' AS region, 'current' AS season, CASE WHEN k % 5 = 0 THEN 'best' ELSE 'recent' END AS source,
        CONCAT('Dungeon ', CAST(k % 8 AS STRING)) AS dungeon, CONCAT('D', CAST(k % 8 AS STRING)) AS short_name, 2 + k % 20 AS mythic_level,
        ts AS completed_at, 1500000 + cents * 10 AS clear_time_ms, CAST(1600000 AS BIGINT) AS par_time_ms,
        CASE WHEN k % 2 = 0 THEN k % 4 ELSE 0 END AS num_keystone_upgrades, k % 8 AS map_challenge_mode_id, k % 8 AS zone_id,
        CAST(k AS DOUBLE) * 1.5 AS score, CONCAT('run/', CAST(event_id AS STRING)) AS url,
        k % 5 = 0 OR 1500000 + cents * 10 <= 1600000 OR (k % 2 = 0 AND k % 4 > 0) AS timed, ts AS snapshot_at, CAST(ts AS STRING) AS _ingested_at
        FROM e WHERE event_type = 'view'""",
    "scores": """SELECT player_name, realm_slug, 'eu' AS region, CONCAT('profile/', player_name) AS profile_url, 'current' AS season,
        CASE WHEN k % 50 = 0 THEN NULL ELSE CAST(cents % 30000 AS DOUBLE) / 10 END AS score_all, CAST(k AS DOUBLE) AS score_dps,
        CAST(k % 7 AS DOUBLE) AS score_healer, CAST(k % 9 AS DOUBLE) * 10 AS score_tank, k * 100 AS world_rank, k * 10 AS region_rank, k AS realm_rank,
        CAST(d AS STRING) AS raiderio_last_crawled_at, ts AS snapshot_at, CAST(ts AS STRING) AS _ingested_at FROM e WHERE event_type = 'view'""",
}


def pruned_ctes(sql: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """The CTEs a statement needs, each after those it reads."""
    every = {**CTES, **(extra or {})}
    found: dict[str, str] = {}
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in every:
            if name not in seen and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                seen.add(name)
                visit(every[name])
                found[name] = every[name]

    visit(sql)
    return found


def with_domain(sql: str, dialect: str, extra: dict[str, str] | None = None) -> str:
    """The statement with the CTEs it reads in front."""
    ctes = pruned_ctes(sql, extra)
    text = ",\n".join(f"{n} AS ({body})" for n, body in ctes.items())
    for key, value in DIALECTS[dialect].items():
        text = text.replace("{" + key + "}", value)
    return f"WITH {text}\n{sql}" if ctes else sql


class Domain:
    """Domain tables of one data folder, planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._frames, self._tables = spark, sf_dir, {}, {}

    def table(self, name: str) -> DataFrame:
        """A driver table."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            text = with_domain(f"SELECT * FROM {name}", "spark")
            text = re.sub(r"\bFROM events\b", "FROM {events}", text)
            self._frames[name] = self.spark.sql(text, events=self.table("events"))
        return self._frames[name]

    def fights(self) -> DataFrame:
        """Pulls with the ids of their players (at most fifty, by the guild rule)."""
        members = self["fight_players"].groupBy("report_code", "fight_id").agg(
            F.array_sort(F.collect_set("user_id")).alias("friendly_player_ids"))
        return self["fights"].drop("fight_end_ms").join(members, ["report_code", "fight_id"])
