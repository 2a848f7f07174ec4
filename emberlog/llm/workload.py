"""Registered queries of the training-data operators, with their statements where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import bloom_dedup, bpe, fair_mix, hard_negatives, hash_search, importance, jaccard_join, language_id, secret_ownership, suffix_dedup, token_counts, url_reputation, warc_bundles

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = function
        if sql:
            _SQL[name] = sql
        return function
    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- op1: url filter -----------------------------------------------------------------------

def _strength_sql(n: str, k: str, mean: str) -> str:
    rho = f"(SUM(({k} - {n} * {mean}) * ({k} - {n} * {mean}) / ({mean} * (1 - {mean}))) - SUM({n})) / SUM({n} * ({n} - 1))"
    limits = f"CASE WHEN COUNT(*) = 0 OR {rho} <= 1 / 1001.0 THEN 1000.0 ELSE ROUND(GREATEST(2.0, 1 / ({rho}) - 1), 6) END"
    return f"SELECT {limits} AS strength"


@query("op1_url_reputation", f"""
WITH urls AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
split AS (SELECT *, string_split(host, '.') AS p FROM urls),
suffixed AS (
  SELECT *, CASE WHEN array_to_string(p[-2:], '.') IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'com.cn', 'org.uk') THEN array_to_string(p[-2:], '.')
                 WHEN contains(host, '.') AND NOT regexp_matches(host, '^[0-9.:]+$|^\\[') THEN p[-1] ELSE '' END AS suffix FROM split),
named AS (
  SELECT *, CASE WHEN suffix = '' THEN host WHEN contains(suffix, '.') THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain FROM suffixed),
outcomes AS (SELECT suffix, domain, host, (quality = 0 OR toxic = 1) AS bad FROM named JOIN labels ON doc_id = page_id),
hosts AS (SELECT suffix, domain, host, COUNT(*) AS n, CAST(SUM(CAST(bad AS BIGINT)) AS BIGINT) AS k FROM outcomes WHERE bad IS NOT NULL GROUP BY ALL),
domains AS (SELECT suffix, domain, CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(k) AS BIGINT) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(k) AS BIGINT) AS k FROM domains GROUP BY ALL),
root AS (SELECT (COALESCE(SUM(k), 0) + 2 * 0.15::DOUBLE) / (COALESCE(SUM(n), 0) + 2) AS rate FROM hosts),
s1 AS (SELECT *, (SELECT rate FROM root) AS prior FROM suffixes),
st1 AS ({_strength_sql('n', 'k', 'prior')} FROM s1 WHERE n > 1),
s2 AS (SELECT *, (k + (SELECT strength FROM st1) * prior) / (n + (SELECT strength FROM st1)) AS mean FROM s1),
d1 AS (SELECT d.*, s2.mean AS prior FROM domains d JOIN s2 USING (suffix)),
st2 AS ({_strength_sql('n', 'k', 'prior')} FROM d1 WHERE n > 1),
d2 AS (SELECT *, (k + (SELECT strength FROM st2) * prior) / (n + (SELECT strength FROM st2)) AS mean FROM d1),
h1 AS (SELECT h.*, d2.mean AS prior FROM hosts h JOIN d2 USING (suffix, domain)),
st3 AS ({_strength_sql('n', 'k', 'prior')} FROM h1 WHERE n > 1),
h2 AS (SELECT *, (k + (SELECT strength FROM st3) * prior) / (n + (SELECT strength FROM st3)) AS mean FROM h1),
scored AS (
  SELECT u.page_id, u.host, u.path, COALESCE(h2.mean, d2.mean, s2.mean, (SELECT rate FROM root)) AS mean,
         CASE WHEN h2.mean IS NOT NULL THEN h2.n + (SELECT strength FROM st3) WHEN d2.mean IS NOT NULL THEN (SELECT strength FROM st3) ELSE 2.0 END AS weight
  FROM named u LEFT JOIN h2 USING (host) LEFT JOIN d2 ON d2.suffix = u.suffix AND d2.domain = u.domain LEFT JOIN s2 ON s2.suffix = u.suffix),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM scored)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN mean - 1.64::DOUBLE * sqrt(mean * (1 - mean) / (weight + 1)) > 0.12::DOUBLE THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""")
def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged; a labelled page is bad if its quality is 0 or it is toxic."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    outcomes = pages.join(labels, pages["page_id"] == labels["doc_id"]).select(
        url_reputation.host_of(F.col("url")).alias("host"), F.expr("quality = 0 OR toxic = 1").alias("bad"))
    return url_reputation.judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


# --- op2: repeated strings -----------------------------------------------------------------

@query("op2_suffix_family_dedup")
def op2_suffix_family_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes over all documents; tests compare with brute force."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    n_bytes = F.octet_length("text").cast("long")
    return found.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept_bytes")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept_bytes", 256).alias("kept_sha256"))


# --- op3: language id ----------------------------------------------------------------------

@query("op3_word_backoff_language")
def op3_word_backoff_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the rows that are not held out, predict all; SQL cannot hold the model, tests compare with brute force."""
    docs = table(spark, sf_dir, "documents")
    outside = language_id.held_out(F.col("doc_id"))
    model = language_id.train(docs.filter(F.col("doc_id").isNotNull() & ~outside))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", outside.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


# --- op4: nearest neighbours ---------------------------------------------------------------

@query("op4_multi_index_hashing")
def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth id against all rows; tests measure recall against brute force."""
    return hash_search.nearest(table(spark, sf_dir, "embeddings"), query_step=20)


# --- op5: WARC -----------------------------------------------------------------------------

@query("op5_seekable_warc", """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
grouped AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN MAX(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS largest FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to FROM grouped""")
def op5_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages, then read every bundle back."""
    folder, _ = warc_bundles.archive(table(spark, sf_dir, "pages"))
    found = warc_bundles.read_bundles(spark, folder)
    return found.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


# --- op6: byte-level BPE -------------------------------------------------------------------

def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary file that the query names; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op6_numpy_bpe")
def op6_numpy_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every text; tests compare with the tokenizers library."""
    tokenizer = bpe.Tokenizer.read(spark, vocabulary_path())
    found = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer, decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256"))


# --- op7: secrets --------------------------------------------------------------------------

_ASSIGN_SQL = secret_ownership.ASSIGN.replace("'", "''")


def _spans_sql(pattern: str, group: int, kind: int, keep: str) -> str:
    """One row per document: list of kept spans (start, kind, end, value) from gap and match lengths."""
    gaps, whole = f"string_split_regex(t, '{pattern}')", f"regexp_extract_all(t, '{pattern}', 0)"
    place = "list_sum(list_transform(g[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: len(x))), 0)"
    spans = f"list_transform(range(1, len(m) + 1), lambda i: {{'s': CAST({place} AS BIGINT), 'k': {kind}, 'e': CAST({place} + len(m[i]) AS BIGINT), 'v': v[i]}})"
    return f"(SELECT list_filter({spans}, lambda x: {keep}) FROM (SELECT {gaps} AS g, {whole} AS m, regexp_extract_all(t, '{pattern}', {group}) AS v))"


@query("op7_secret_ownership", f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
found AS (SELECT r, doc_id, source,
    {_spans_sql(_ASSIGN_SQL, 2, 0, 'len(x.v) >= 6')} AS assign, {_spans_sql(secret_ownership.ACCESS, 0, 1, 'true')} AS access,
    {_spans_sql(secret_ownership.HEX, 0, 2, 'true')} AS hex,
    {_spans_sql(secret_ownership.BARE, 0, 3, "regexp_matches(x.v, '[0-9]') AND regexp_matches(x.v, '[A-Za-z]')")} AS bare FROM docs),
candidates AS (SELECT r, doc_id, source, unnest(assign || access || hex || bare) AS c FROM found),
counts AS (SELECT c.v AS v, COUNT(DISTINCT coalesce(source, '<null>')) AS owners, COUNT(DISTINCT (source, doc_id)) AS repositories FROM candidates GROUP BY c.v),
live AS (SELECT r, list_sort(list_distinct(list({{'s': c.e - len(c.v), 'k': 3, 'e': c.e, 'v': c.v}}))) AS live
         FROM candidates JOIN counts ON c.v = counts.v WHERE owners <= 1 AND repositories <= 3 GROUP BY r),
merged AS (SELECT f.*, list_sort(assign || access || hex) AS base, list_sort(assign || access || hex || coalesce(live, [])) AS every FROM found f LEFT JOIN live USING (r))
SELECT doc_id, CAST(len(assign) AS BIGINT) AS n_assign, CAST(len(access) AS BIGINT) AS n_access, CAST(len(hex) AS BIGINT) AS n_hex,
       sha256(array_to_string(list_transform(base, lambda x: ['assign', 'access', 'hex', 'live'][x.k + 1] || ':' || x.s || ':' || x.e), ',')) AS base_sha256,
       array_to_string(list_transform(every, lambda x: ['assign', 'access', 'hex', 'live'][x.k + 1] || ':' || x.s || ':' || x.e), ',') AS spans
FROM merged""")
def op7_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ownership.scan(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return found.select("doc_id", *(secret_ownership.count_of(base, k).alias(f"n_{secret_ownership.KINDS[k]}") for k in range(3)),
                        F.sha2(secret_ownership.span_text(base).cast("binary"), 256).alias("base_sha256"),
                        secret_ownership.span_text(F.sort_array(F.concat("base", "live"))).alias("spans"))


# --- op8: mixing ---------------------------------------------------------------------------

@query("op8_fair_mix", r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                      md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS shuffle_key FROM documents),
sources AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank FROM sources),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(source_rank - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM ranked),
filled AS (SELECT *, cap / weight AS fill FROM weighed),
levels AS (SELECT *, (1.5::DOUBLE * SUM(source_size) OVER () - (CAST(SUM(cap) OVER (ORDER BY fill, source_rank ROWS UNBOUNDED PRECEDING) AS BIGINT) - cap))
                     / SUM(weight) OVER (ORDER BY fill, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level FROM filled),
shares AS (SELECT *, least(CAST(cap AS DOUBLE), coalesce((SELECT arg_min(own_level, (fill, source_rank)) FROM levels WHERE own_level < fill) * weight, CAST(cap AS DOUBLE))) AS target FROM levels),
queued AS (SELECT d.*, s.source_size, s.source_rank, s.target,
                  CAST(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.shuffle_key, d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS position
           FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
copies AS (SELECT *, copy * source_size + position AS place FROM queued, (VALUES (0), (1)) c(copy) WHERE size > 0),
ordered AS (SELECT *, SUM(size) OVER (ORDER BY place / target, source_rank, place ROWS UNBOUNDED PRECEDING) AS through FROM copies),
taken AS (SELECT doc_id, source, position, SUM(size) AS taken FROM ordered WHERE through <= (SELECT 1.5::DOUBLE * SUM(size) FROM sized) GROUP BY ALL)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.source IS NOT DISTINCT FROM t.source AND q.position = t.position AND q.size > 0""")
def op8_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# --- op9: exact dedup ----------------------------------------------------------------------

@query("op9_bloom_dedup", """
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, MAX(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, COUNT(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM MAX(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256 FROM hashed""")
def op9_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bloom_dedup.annotate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


# --- op10: near duplicates -----------------------------------------------------------------

@query("op10_prefix_jaccard", r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
rows AS (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM rows a JOIN rows b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 90 * (a.n + b.n - COUNT(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT a, MIN(b) AS b FROM r GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(reach.b, doc_id)) AS component_id FROM sets LEFT JOIN reach ON reach.a = doc_id""")
def op10_prefix_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity of 0.9 or more."""
    return jaccard_join.cluster(table(spark, sf_dir, "documents"), k=3, percent=90)


@query("op10_link_counts", r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
rows AS (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM rows a JOIN rows b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 90 * (a.n + b.n - COUNT(*)))
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT COUNT(*) FROM pairs WHERE a = doc_id) AS n_links FROM sets""")
def op10_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link counted at both documents; three-word shingles, similarity of 0.9 or more."""
    return jaccard_join.link_counts(table(spark, sf_dir, "documents"), k=3, percent=90)


# --- op11: hard negatives ------------------------------------------------------------------

@query("op11_zone_map_negatives", """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.r <> b.r),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5),
negatives AS (
  SELECT p.a, p.b, p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id, n.b) AS rank
  FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3""")
def op11_zone_map_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth id against all rows, after the labels of every seventh id are moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), moved, anchor_step=50)


# --- op12: token counts --------------------------------------------------------------------

@query("op12_transducer_token_counts")
def op12_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text; SQL cannot hold the machines, tests compare with the tokenizers library."""
    vocabulary = token_counts.Vocabulary.read(vocabulary_path("word_bpe_49k.json"))
    return token_counts.count(table(spark, sf_dir, "documents"), vocabulary, limit=2048)


# --- op13: importance resampling -----------------------------------------------------------

@query("op13_overlapped_resampling", r"""
WITH crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
texts AS (SELECT 0 AS side, row_number() OVER () AS r, text FROM documents UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
words AS MATERIALIZED (
  SELECT side, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                     list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g FROM words),
counted AS MATERIALIZED (SELECT side, r, g, COUNT(*) AS n FROM grams GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, strlen(g)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g, hex(encode(g)) AS h FROM counted), crc_table),
features AS MATERIALIZED (SELECT side, r, bucket, CAST(SUM(n) AS BIGINT) AS n FROM counted JOIN hashed USING (g) GROUP BY ALL),
totals AS (SELECT b.bucket, CAST(coalesce(SUM(n) FILTER (WHERE side = 0), 0) AS DOUBLE) AS s, CAST(coalesce(SUM(n) FILTER (WHERE side = 1), 0) AS DOUBLE) AS t
           FROM (SELECT range AS bucket FROM range(10000)) b LEFT JOIN features f ON f.bucket = b.bucket GROUP BY b.bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT SUM(s) FROM totals) + 10000) / ((s + 1) * ((SELECT SUM(t) FROM totals) + 10000)))) AS BIGINT) AS gain FROM totals),
summed AS (SELECT r, CAST(SUM(n) AS BIGINT) AS n_features, CAST(SUM(n * gain) AS BIGINT) AS weight FROM features JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
noise AS (SELECT row_number() OVER () AS r, doc_id, CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM documents),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM noise JOIN words USING (r) LEFT JOIN summed USING (r) WHERE side = 0),
ranked AS (SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) END AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * (SELECT COUNT(*) FROM scored WHERE n_words >= 20) // 100 THEN place END AS rank FROM ranked""")
def op13_overlapped_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
