"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The words of a block of texts are made distinct and laid out as one flat array of symbols. Each round
looks up all neighbouring pairs by binary search in the sorted pair keys, finds every word's pair of
lowest rank, and merges all its occurrences in that word from left to right. Words without a known
pair leave the array. Tokens are gathered back to texts by offsets, and decoded the same way.

Defined cases: a null text is empty and has no tokens. Special tokens found in a text are single
tokens. A text of any length is encoded whole; blocks only bound how many texts are held at once.
Bytes of ids that do not form UTF-8 decode to the replacement character. Repeated rows are encoded each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from emberlog.llm.blocks import text_blocks

# Fixed value: the pattern that splits text before the merges; white space is spelled out so that all
# pattern engines agree on it.
_S = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
NO_RANK = np.int64(1) << 40


def byte_letters() -> list[str]:
    """Letter of each byte in the vocabulary file: printable bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Tokenizer:
    """Merge table and token bytes of a vocabulary file as arrays; small and of fixed size."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocabulary[c] for c in letters], np.int64)
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)  # by rank
        tokens: list[bytes] = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for token, number in vocabulary.items():
            tokens[number] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        for token, number in special.items():
            tokens[number] = token.encode()
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.special = special

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Tokenizer:
        """From a JSON vocabulary file that the driver can open; executors get the arrays."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        return cls(spec["model"]["vocab"], merges, {t["content"]: t["id"] for t in spec["added_tokens"]})

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all words and the number of ids of each."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols, word = self.first[np.frombuffer(b"".join(words), np.uint8)], np.repeat(np.arange(len(words)), sizes)
        rank = self._pair_ranks(symbols, word)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            lengths = np.diff(starts, append=len(word))
            lowest = np.minimum.reduceat(rank, starts)
            active = np.repeat(lowest < NO_RANK, lengths)
            if not active.all():
                done.append((word[~active], symbols[~active]))
                symbols, word, rank = symbols[active], word[active], rank[active]
                lengths, lowest = lengths[lowest < NO_RANK], lowest[lowest < NO_RANK]
                if not len(symbols):
                    break
            merge = rank == np.repeat(lowest, lengths)
            # of overlapping occurrences, such as in a run of one letter, every second from the left is merged
            at = np.flatnonzero(merge)
            run = np.cumsum(np.diff(at, prepend=-2) != 1) - 1
            first = at[np.flatnonzero(np.diff(run, prepend=-1))]
            at = at[(at - first[run]) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            symbols, word, rank, changed = symbols[kept], word[kept], rank[kept], changed[kept]
            changed[:-1] |= changed[1:] & (word[:-1] == word[1:])
            again = np.flatnonzero(changed)
            rank[again] = self._pair_ranks(symbols, word, again)
        if not done:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        word, symbols = (np.concatenate([d[i] for d in done]) for i in range(2))
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _pair_ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Rank of each symbol with the next of its word."""
        at = np.arange(len(symbols)) if at is None else at
        after = np.minimum(at + 1, max(len(symbols) - 1, 0))
        inside = (at + 1 < len(symbols)) & (word[after] == word[at])
        out = np.full(len(at), NO_RANK)
        out[inside] = self._lookup(symbols[at[inside]], symbols[after[inside]])
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        split = regex.compile(PATTERN).findall
        cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        words, counts = [], []
        for text in texts:
            before = len(words)
            for part in cut.split(text) if cut and text else [text or ""]:
                if part in self.special:
                    words.append(part)
                elif part:
                    words += split(part)
            counts.append(len(words) - before)
        if not words:
            return [np.empty(0, "<u4")] * len(texts)
        codes, distinct = pd.factorize(np.array(words, object))
        ids, sizes = self.encode_words([b"" if w in self.special else w.encode() for w in distinct])
        for at in np.flatnonzero([w in self.special for w in distinct]):
            ids, sizes[at] = np.insert(ids, int(sizes[:at].sum()), self.special[distinct[at]]), 1
        flat, lengths = _gather(ids, np.cumsum(sizes) - sizes, sizes, codes)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        return np.split(flat.astype("<u4"), ends[:-1])

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        counts = np.array([len(x) for x in ids], np.int64)
        if not counts.sum():
            return [""] * len(ids)
        flat, lengths = _gather(self.bytes, self.starts, self.sizes, np.concatenate(ids).astype(np.int64))
        data, ends = flat.tobytes(), np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        return [data[s:e].decode("utf-8", "replace") for s, e in zip([0, *ends[:-1]], ends)]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices ``codes`` of ``flat`` one after the other, and their lengths."""
    lengths = sizes[codes]
    offset = starts[codes] - (np.cumsum(lengths) - lengths)
    return flat[np.repeat(offset, lengths) + np.arange(lengths.sum())], lengths


def encode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` plus ``n_tokens`` and ``token_ids`` (binary, little-endian unsigned 32-bit); with ``decoded``, the text made from those ids too."""
    added = ["n_tokens", "token_ids", *["decoded_text"] * decoded]
    if clash := set(added) & set(df.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, text):
            ids = shared.value.encode(block.column(text).to_pylist())
            columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]
            if decoded:
                columns.append(pa.array(shared.value.decode(ids), pa.string()))
            yield pa.RecordBatch.from_arrays([*block.columns, *columns], names=[*block.schema.names, *added])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, n_tokens long, token_ids binary{', decoded_text string' * decoded}")


def decode(df: DataFrame, tokenizer: Tokenizer, token_ids: str = "token_ids") -> DataFrame:
    """``df`` plus ``decoded_text`` from a column of packed ids; null ids decode to an empty text."""
    if "decoded_text" in df.columns:
        raise ValueError("reserved column names: ['decoded_text']")
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, token_ids):
            texts = shared.value.decode([np.frombuffer(x or b"", "<u4") for x in block.column(token_ids).to_pylist()])
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(texts, pa.string())], names=[*block.schema.names, "decoded_text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, decoded_text string")
