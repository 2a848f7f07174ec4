"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. An unseen word falls back to the longest
character n-grams of it that are known, from ``LONGEST`` down to single characters. A document's
score is the sum over its words; the prediction is the largest, its score the posterior under equal priors.

The model is two sorted arrays of 64-bit keys (words, n-grams) with one row of log frequencies each, so it has
the size of its numbers and is searched for all unseen words of a block at once.

The model is fitted on a bounded sample of the labelled rows: the ``per_language`` documents of each
language that come first in hash order, whole texts, and of their words the ``max_words`` most frequent
of each language. It is therefore of fixed size per language and broadcast. Prediction covers all rows.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if no
labelled row exists; letters are those of Unicode category L, so "½" or "Ⅷ" alone is no word. A word of
which no n-gram is known counts for no language. Ties go to the language first in code point order.
Labels of null text or null language are not learned from; rows that share an id count within the same bound.
Repeated rows get equal results. Very long texts are counted whole. An empty table gives an empty result.
Further columns pass through; columns named ``lang_pred`` or ``lang_score`` are an error, raised before anything runs.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.blocks import text_blocks

PER_LANGUAGE = 1000
MAX_WORDS = 30_000
LONGEST = 5
CACHE_WORDS = 65_536
UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def held_out(doc_id: Column) -> Column:
    """Every fourth document by the CRC-32 of its id as text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams_of(word: str, n: int) -> list[str]:
    """Runs of ``n`` characters; longer ones than single characters see the word's ends as ``^`` and ``$``."""
    marked = f"^{word}$" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _keys(names: list[str]) -> np.ndarray:
    """64-bit keys of strings, the same in every process."""
    return pd.util.hash_array(np.array(names, object), categorize=False)


class _Table:
    """Add-one-half smoothed log frequencies, one row per name, found by sorted key."""

    def __init__(self, counts: dict[str, Counter], languages: list[str]):
        seen = sorted({x for c in counts.values() for x in c})
        table = np.array([[counts[lang].get(x, 0) for lang in languages] for x in seen], float).reshape(len(seen), len(languages)) + 0.5
        keys = _keys(seen) if seen else np.empty(0, np.uint64)
        order = np.argsort(keys)
        self.keys, self.rows = keys[order], np.log(table / table.sum(0))[order] if seen else table

    def find(self, names: list[str]) -> np.ndarray:
        """Row of each name, -1 where it is unknown."""
        if not len(self.keys) or not names:
            return np.full(len(names), -1)
        keys = _keys(names)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


class Model:
    """Log frequencies of words and of n-grams of each length, one column per language."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.languages = sorted(counts)
        self.words = _Table({lang: Counter(c) for lang, c in counts.items()}, self.languages)
        self.grams = {}
        for n in range(1, LONGEST + 1):
            grams: dict[str, Counter] = defaultdict(Counter)
            for lang, known in counts.items():
                for word, count in known.items():
                    for gram in grams_of(word, n):
                        grams[lang][gram] += count
            self.grams[n] = _Table(grams, self.languages)

    def vectors(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words: their own row, else the mean of their longest known n-grams, else nothing."""
        out = np.zeros((len(words), len(self.languages)))
        found = self.words.find(words)
        out[found >= 0] = self.words.rows[found[found >= 0]]
        open_words = np.flatnonzero(found < 0)
        for n in range(LONGEST, 0, -1):
            if not len(open_words):
                break
            lists = [grams_of(words[i], n) for i in open_words]
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            row = self.grams[n].find([g for x in lists for g in x])
            owner, row = owner[row >= 0], row[row >= 0]
            known = np.bincount(owner, minlength=len(lists))
            for lang in range(len(self.languages)):
                sums = np.bincount(owner, self.grams[n].rows[row, lang], minlength=len(lists))
                out[open_words[known > 0], lang] = sums[known > 0] / known[known > 0]
            open_words = open_words[known == 0]
        return out

    def predict(self, texts: list[str | None], cache: Cache) -> tuple[list[str], np.ndarray]:
        lists = [words_of(t) if t else [] for t in texts]
        lengths = np.array([len(x) for x in lists], np.int64)
        labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages or not lengths.sum():
            return labels, scores
        codes, words = pd.factorize(np.array([w for x in lists for w in x], object))
        rows = cache.rows_of(words.tolist(), self)
        filled = np.flatnonzero(lengths)
        starts = (np.cumsum(lengths) - lengths)[filled]
        sums = np.add.reduceat(rows[codes], starts, axis=0)
        odds = np.exp(sums - sums.max(1, keepdims=True))
        best = sums.argmax(1)
        for at, lang, score in zip(filled, best, 1 / odds.sum(1)):
            labels[at], scores[at] = self.languages[lang], round(float(score), 6)
        return labels, scores


class Cache:
    """Rows of the words met last, in one matrix."""

    def __init__(self, languages: int):
        self.rows, self.at = np.empty((CACHE_WORDS, languages)), {}

    def rows_of(self, words: list[str], model: Model) -> np.ndarray:
        new = [w for w in words if w not in self.at]
        if len(self.at) + len(new) > CACHE_WORDS:
            self.at, new = {}, words
        vectors = model.vectors(new)
        if len(new) > CACHE_WORDS:
            return vectors
        self.rows[len(self.at):len(self.at) + len(new)] = vectors
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        return self.rows[[self.at[w] for w in words]]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[lang].update(words_of(text))
    rows = [(lang, word, n) for lang, c in counts.items() for word, n in c.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = PER_LANGUAGE, max_words: int = MAX_WORDS) -> Model:
    """Fit on at most ``per_language`` documents and ``max_words`` words of each language."""
    usable = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    usable = usable.select(F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("at", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    keys = usable.select("lang", "doc_id", "at")
    # one row per language; of a frequent one only about four times the ids wanted are ranked at all
    counts = keys.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(4.0 * per_language) / F.approx_count_distinct("at")).alias("share")).withColumnRenamed("lang", "of_lang")
    keys = keys.join(F.broadcast(counts), F.col("lang") == F.col("of_lang")).filter(F.col("at") < F.col("share") * (1 << 40)).select("lang", "doc_id", "at").distinct()
    first = Window.partitionBy("lang").orderBy("at", "doc_id")
    chosen = keys.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_language)
    chosen = chosen.select(F.col("lang").alias("c_lang"), F.col("doc_id").alias("c_id")).distinct()
    sample = usable.join(F.broadcast(chosen), (F.col("lang") == F.col("c_lang")) & F.col("doc_id").eqNullSafe(F.col("c_id")), "left_semi")
    # an id that many rows share brings them all back, so the bound is taken once more
    again = Window.partitionBy("lang").orderBy("at", "doc_id", F.xxhash64("text"))
    sample = sample.withColumn("rank", F.row_number().over(again)).filter(F.col("rank") <= per_language)
    counts = sample.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    often = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    model: dict[str, dict[str, int]] = defaultdict(dict)
    for row in counts.withColumn("at", F.row_number().over(often)).filter(F.col("at") <= max_words).toLocalIterator():
        model[row["lang"]][row["word"]] = row["n"]
    return Model(model)


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` plus ``lang_pred`` and ``lang_score``."""
    if clash := {"lang_pred", "lang_score"} & set(df.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(len(shared.value.languages))
        for block in text_blocks(batches, text):
            labels, scores = shared.value.predict(block.column(text).to_pylist(), cache)
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(labels, pa.string()), pa.array(scores)], names=[*block.schema.names, "lang_pred", "lang_score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, lang_pred string, lang_score double")
