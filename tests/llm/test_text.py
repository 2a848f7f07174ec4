"""Language identification, byte-level BPE and secret scans."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from emberlog.llm import bpe, language_id, secret_ownership
from emberlog.llm.blocks import text_blocks
from emberlog.llm.workload import queries, vocabulary_path

# --- language ------------------------------------------------------------------------------

TRAIN = [(1, "the cat and the dog", "en", "s"), (2, "the bird sings and sings", "en", "s"), (3, "le chat et le chien", "fr", "s"), (5, "la souris chante", "fr", "s"), (7, None, "en", "s"), (8, "the", None, "s")]


def plain_prediction(counts, text):
    """The method, word by word, without arrays."""
    found = regex.findall(r"\p{L}+", (text or "").lower())
    if not found or not counts:
        return "und", 0.0
    languages = sorted(counts)

    def logs(tables):
        seen = {x for t in tables.values() for x in t}
        totals = {lang: sum(tables[lang].values()) + len(seen) / 2 for lang in languages}
        return seen, lambda x: [math.log((tables[lang].get(x, 0) + 0.5) / totals[lang]) for lang in languages]

    words = logs(counts)
    grams = {n: logs({lang: Counter(g for w, c in counts[lang].items() for g in language_id.grams_of(w, n) for _ in range(c)) for lang in languages}) for n in range(1, 6)}
    sums = [0.0] * len(languages)
    for word in found:
        vectors = [words[1](word)] if word in words[0] else []
        for n in range(5, 0, -1):
            vectors = vectors or [grams[n][1](g) for g in language_id.grams_of(word, n) if g in grams[n][0]]
        for i in range(len(languages)):
            sums[i] += sum(v[i] for v in vectors) / len(vectors) if vectors else 0.0
    best = max(range(len(languages)), key=lambda i: (sums[i], -i))
    return languages[best], round(1 / sum(math.exp(s - sums[best]) for s in sums), 6)


def test_language_equals_plain_method(docs):
    model = language_id.train(docs(TRAIN, extra=True))
    counts = defaultdict(Counter)
    for _, text, lang, _ in TRAIN:
        if text and lang:
            counts[lang].update(language_id.words_of(text))
    texts = ["the dog", "le chien chantait", "catlike birds", "zzz qqq", "123 _ --", "", None, "THE Cat", "the le", "chat " * 40_000, "ß", "½ ² Ⅷ", "½ dog", "qqqq"]
    found = {r["doc_id"]: (r["lang_pred"], r["lang_score"]) for r in language_id.identify(docs(list(enumerate(texts)), extra=True), model).collect()}
    for i, text in enumerate(texts):
        label, score = plain_prediction(counts, text)
        assert found[i][0] == label and found[i][1] == pytest.approx(score, abs=2e-6), text


def test_language_without_labels_or_rows(docs):
    model = language_id.train(docs([(1, "a b", None, "s")]))
    assert [r["lang_pred"] for r in language_id.identify(docs([(1, "a b")]), model).collect()] == ["und"]
    assert language_id.identify(docs([]), model).count() == 0
    with pytest.raises(ValueError):
        language_id.identify(docs([(1, "a")]).withColumn("lang_pred", F.lit("x")), model)


def test_language_sample_is_bounded(docs):
    model = language_id.train(docs([(i, f"word{chr(97 + i % 26)} x{'y' * i}", "en", "s") for i in range(50)]), per_language=3, max_words=4)
    assert len(model.words.keys) <= 4
    same_id = language_id.train(docs([(7, f"word{chr(97 + i % 26)}{chr(97 + i // 26)}", "en", "s") for i in range(50)]), per_language=3)
    assert 0 < len(same_id.words.keys) <= 3


def test_language_model_holds_no_objects_per_word(docs):
    model = language_id.train(docs(TRAIN))
    assert isinstance(model.words.keys, np.ndarray) and all(isinstance(t.rows, np.ndarray) and len(t.rows) == len(t.keys) for t in model.grams.values())


def test_language_cache_is_cleared(docs, monkeypatch):
    model = language_id.train(docs(TRAIN))
    texts = [f"the chat {'q' * i} dog{chr(97 + i)}" for i in range(1, 20)]
    want = model.predict(texts, language_id.Cache(2))
    monkeypatch.setattr(language_id, "CACHE_WORDS", 5)
    cache = language_id.Cache(2)
    assert [model.predict([t], cache)[0][0] for t in texts] == want[0]


def test_held_out_accuracy(spark, sf_dir):
    rows = queries()["op3_word_backoff_language"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL AND lang_pred != 'und'").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert len(rows) > 20 and right / len(rows) > 0.9


def test_held_out_split(spark):
    import zlib

    rows = spark.range(200).select("id", language_id.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(language_id.held_out(F.col("id"))).first()[0] is False


# --- BPE -----------------------------------------------------------------------------------

HARD = ["", None, "a<|endoftext|>b <|endoftext|>", "aaaaaaaaaaaaaaaaaa aaa", "  \n\n x\t\ty  ", "don't WE'LL I've", "e\u0301 \u2460\u00b2 \u4e2d\u6587 \U0001f389\U0001f389",
        "\x1c\x1d a\x85b\xa0c\u1680\u180e\u200bz\u3000", "x" * 5000, "ab" * 3000 + " " * 100 + "\n" * 50, "w" * 200_000, " ".join(map(str, range(40_000)))]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def test_ids_and_text_equal_the_library(spark, docs, reference):
    rng = random.Random(5)
    texts = HARD + ["".join(rng.choice("abcdeé ñ'\n1 9中🎉.,") for _ in range(rng.randrange(400))) for _ in range(60)]
    tokenizer = bpe.Tokenizer.read(spark, vocabulary_path())
    encoded = bpe.encode(docs(list(enumerate(texts)), extra=True), tokenizer)
    found = {r["doc_id"]: r for r in bpe.decode(encoded, tokenizer).collect()}
    for i, text in enumerate(texts):
        ids = reference.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(found[i]["token_ids"], "<u4").tolist() == ids and found[i]["n_tokens"] == len(ids), i
        assert found[i]["decoded_text"] == reference.decode(ids, skip_special_tokens=False), i


def test_whole_documents_equal_the_library(spark, sf_dir, reference):
    tokenizer = bpe.Tokenizer.read(spark, vocabulary_path())
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert [x.tolist() for x in tokenizer.encode(texts)] == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_bpe_of_odd_ids_nothing_and_clashes(spark, docs, reference):
    tokenizer = bpe.Tokenizer.read(spark, vocabulary_path())
    cut = reference.encode("🎉", add_special_tokens=False).ids[:1]
    assert tokenizer.decode([np.array(cut), np.array([], int)]) == [reference.decode(cut, skip_special_tokens=False), ""]
    assert bpe.encode(docs([]), tokenizer, decoded=True).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs([(1, "a")]).withColumn("n_tokens", F.lit(1)), tokenizer)


def test_blocks_keep_all_rows_in_order():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 5, None, "b" * 50, "", "c" * 3])], names=["text"])
    blocks = list(text_blocks([batch, batch.slice(0, 0)], "text", 8))
    assert [x for b in blocks for x in b.column(0).to_pylist()] == batch.column(0).to_pylist() and len(blocks) == 4


# --- secrets -------------------------------------------------------------------------------

KEY, TOKEN = "AKIA" + "Q7" * 8, "d0" * 12
SECRETS = [
    (1, f"password = 'hunter22' and {KEY}", None, "a"), (2, f"see {KEY}", None, "b"), (3, f"ñ🎉 API_KEY:{TOKEN} end", None, "a"), (4, f"x {TOKEN}", None, "a"),
    (5, "token=ab token=token:abcdefgh", None, "a"), (6, None, None, None), (7, "", None, "a"), (8, "AKIASHORT deadbeef", None, "a"),
    (9, "Zx9" * 10 + " tail", None, "a"), (10, ("secret: abcdef" + "0123 " + "y" * 50 + "\n") * 3000, None, None), (11, f"see {KEY}", None, "b"), (None, "passwd=qwertyu", None, "c"),
]


def plain_secrets(rows):
    def matches(text):
        base = [(m.start(), 0, m.end(), m[2]) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        bare = [(m.start(), 3, m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
        return sorted(base), bare

    found = [(doc, owner, *matches(text or "")) for doc, text, _, owner in rows]
    owners, places = defaultdict(set), defaultdict(set)
    for doc, owner, base, bare in found:
        for *_, value in base + bare:
            owners[value].add(owner)
            places[value].add((owner, doc))
    out = {}
    for doc, owner, base, bare in found:
        live = {(end - len(v), 3, end, v) for _, _, end, v in base + bare if len(owners[v]) <= 1 and len(places[v]) <= 3}
        out[doc] = (base, sorted(live))
    return out


def test_secrets_equal_plain_scan(docs):
    found = {r["doc_id"]: tuple([(s["start"], s["kind"], s["end"], s["value"]) for s in r[k]] for k in ("base", "live")) for r in secret_ownership.scan(docs(SECRETS, extra=True)).collect()}
    want = plain_secrets(SECRETS)
    for doc in want:
        assert found[doc] == want[doc], doc
    assert not found[1][1] or all(v != KEY for *_, v in found[1][1])  # seen with two owners


def test_secrets_of_repeated_rows_and_nothing(docs):
    rows = secret_ownership.scan(docs([(1, "password=abcdef", None, "a")] * 2)).collect()
    assert len(rows) == 2 and all(len(r["live"]) == 1 and len(r["base"]) == 1 for r in rows)
    assert secret_ownership.scan(docs([])).count() == 0
