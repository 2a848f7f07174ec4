"""Token counts by deterministic transducers compiled from a BPE vocabulary with word ends.

Two machines, both deterministic, read a text:

* The *word machine* has six states over nine character classes and finds where words begin. A text is
  cut into chunks; each chunk's map from entry state to exit state is computed for all chunks at once, the
  maps are composed by a parallel prefix scan, and a second pass from the then known entry states marks the
  beginnings.
* The *merge machine* reads a word's bytes, the last one as a word-end symbol, and each of its transitions
  carries the number of tokens that the word's encoding grows by (less than one where the byte merges
  earlier tokens). It is the weighted subset construction of the rule that a token sequence is the
  encoding of its bytes exactly if every two neighbours encode to themselves: a state holds, for each place
  from which a token may still be running, the class of the token that ends there, the place in the vocabulary
  trie and the token count there relative to the present one. Transitions are compiled where first needed and
  kept in sorted arrays, so that all words of a block step together by binary search.

A word's count is the sum of its transitions' numbers, a text's count that of its words and special tokens.

Defined cases: a null or empty text has no bytes and no tokens. Special tokens written inside a text count
one each. A very long text is counted whole, in slices cut before white space; a piece without any white
space is one slice. A machine that has grown past ``MAX_STATES`` states is dropped and compiled anew, which
changes no count. Repeated rows are counted each, empty tables give empty results. Only the id and text
columns are read and the result has its own columns, so further columns of any name neither clash nor appear.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from emberlog.llm.blocks import text_blocks
from emberlog.llm.bpe import byte_letters

MAX_STATES = 1 << 18
SLICE_CHARS = 1 << 20
CHUNK_CHARS = 512
LONG_WORD = 128

# Character classes; the apostrophe opens 's 't 'm 'd, 're 've and 'll, which are words of their own.
SPACE, LETTER, DIGIT, OTHER, QUOTE, STMD, RV, E, ELL = range(9)
# States after a character: no open run; in letters; in other signs; after an apostrophe that began a word;
# after such an apostrophe and r or v; after such an apostrophe and l.
IDLE, WORD, SIGNS, OPEN, OPEN_RV, OPEN_ELL = range(6)
#          space  letter digit other  quote  stmd  r, v     e     l
_MOVES = [[IDLE, WORD, IDLE, SIGNS, OPEN, WORD, WORD, WORD, WORD],
          [IDLE, WORD, IDLE, SIGNS, OPEN, WORD, WORD, WORD, WORD],
          [IDLE, WORD, IDLE, SIGNS, SIGNS, WORD, WORD, WORD, WORD],
          [IDLE, WORD, IDLE, SIGNS, SIGNS, IDLE, OPEN_RV, WORD, OPEN_ELL],
          [IDLE, WORD, IDLE, SIGNS, OPEN, WORD, WORD, IDLE, WORD],
          [IDLE, WORD, IDLE, SIGNS, OPEN, WORD, WORD, WORD, IDLE]]
# Emitted with a move: 1 a word begins at this character, 2 one began at the character before it.
_MARKS = [[0, 1, 1, 1, 1, 1, 1, 1, 1],
          [0, 0, 1, 1, 1, 0, 0, 0, 0],
          [0, 1, 1, 0, 0, 1, 1, 1, 1],
          [0, 1, 1, 0, 0, 0, 0, 1, 0],
          [2, 2, 3, 3, 3, 2, 2, 0, 2],
          [2, 2, 3, 3, 3, 2, 2, 2, 0]]
MOVES, MARKS = np.array(_MOVES, np.uint8), np.array(_MARKS, np.uint8)


def exit_states(classes: np.ndarray, chunk: int = CHUNK_CHARS) -> np.ndarray:
    """State before each character, starting idle: chunk maps, their prefix scan, and a pass from known entries."""
    count = -(-len(classes) // chunk)
    padded = np.zeros(count * chunk, np.uint8)
    padded[:len(classes)] = classes
    columns = padded.reshape(count, chunk).T.copy()
    flat = MOVES.T.copy().ravel()  # class * states + state
    maps = np.tile(np.arange(len(MOVES), dtype=np.uint8), (count, 1))
    for column in columns:
        maps = flat[column[:, None].astype(np.intp) * len(MOVES) + maps]
    step = 1
    while step < count:  # after each round a map covers twice as many chunks
        later = maps.copy()
        later[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
        maps, step = later, step * 2
    state = np.concatenate([[IDLE], maps[:-1, IDLE]]).astype(np.uint8)
    before = np.empty((chunk, count), np.uint8)
    for at, column in enumerate(columns):
        before[at] = state
        state = flat[column.astype(np.intp) * len(MOVES) + state]
    return before.T.ravel()[:len(classes)]


def word_starts(classes: np.ndarray, chunk: int = CHUNK_CHARS) -> np.ndarray:
    """Whether a word begins at each character; the last character must be a space."""
    marks = MARKS[exit_states(classes, chunk), classes]
    begins = (marks & 1).astype(bool)
    begins[:-1] |= marks[1:] >= 2
    return begins


class Vocabulary:
    """Merge ranks, token bytes and character classes of a vocabulary file; small and of fixed size."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.normalizer = json.dumps(spec["normalizer"])
        letters = byte_letters()
        ids, of = model["vocab"], {letter: b for b, letter in enumerate(letters)}
        self.symbols = [ids[x] for x in letters] + [ids[x + self.suffix] for x in letters]
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[ids[left], ids[right]] = (rank, ids[left.removesuffix(self.suffix) + right])
        # a token as symbols: its bytes, the last one as a word-end symbol where it closes a word
        self.tokens = {}
        for token, i in ids.items():
            closes = token.endswith(self.suffix) and len(token) > len(self.suffix)
            data = [of[x] for x in (token.removesuffix(self.suffix) if closes else token)]
            self.tokens[i] = tuple(data[:-1] + [data[-1] + 256 * closes])
        self.classes = character_classes()

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            return cls(file.read())


def character_classes() -> bytes:
    """Class of every code point, as the library's own patterns tell letters, digits and white space."""
    table = np.full(0x110000, OTHER, np.uint8)
    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000], np.int64)
    every = "".join(map(chr, points))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", SPACE)):
        found = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every)
        table[points[[start for _, (start, _) in found]]] = kind
    for letters, kind in (("'", QUOTE), ("stmd", STMD), ("rv", RV), ("e", E), ("l", ELL)):
        table[[ord(x) for x in letters]] = kind
    return table.tobytes()


class MergeMachine:
    """States and transitions compiled so far.

    Two tokens are neighbours if no merge of the sweep through all ranks joins them: a merge of a node of the
    left token's right edge and a node of the right token's left edge, of a rank at which both exist. Left
    tokens whose right edges offer the same merges are one class, and a state holds classes, not tokens.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        made = {merged: (rank, left, right) for (left, right), (rank, merged) in reversed(vocabulary.merges.items())}
        self.opens = {left for left, _ in vocabulary.merges}
        self.made = made
        self.left_edges: dict[int, tuple] = {}
        self.classes: dict[tuple, int] = {(): 0}  # class 0 also stands for the start of a word
        self.edges: list[tuple] = [()]
        self.class_of: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.resets = 0
        # trie over symbols; closed[node] is the token that ends there, if its own bytes encode to it
        self.children: list[dict[int, int]] = [{}]
        self.closed: list[int | None] = [None]
        for token, symbols in vocabulary.tokens.items():
            if not self._whole(token, symbols):
                continue
            node = 0
            for symbol in symbols:
                following = self.children[node].get(symbol)
                if following is None:
                    following = self.children[node][symbol] = len(self.children)
                    self.children.append({})
                    self.closed.append(None)
                node = following
            self.closed[node] = token
        self.reset()

    def reset(self) -> None:
        self.resets += 1
        start = ((0, 0, 0),)
        self.states: list[tuple] = [start]
        self.number = {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}
        self.new: list[int] = []
        self.keys, self.targets, self.gains = (np.empty(0, np.int64) for _ in range(3))

    def _whole(self, token: int, symbols: tuple[int, ...]) -> bool:
        """Whether the token's bytes encode to the token."""
        return encode_symbols([self.vocabulary.symbols[s] for s in symbols], self.vocabulary.merges) == [token]

    def _edge(self, token: int, side: int) -> tuple:
        """Nodes down one edge of a token's merge tree, with the ranks at which each is made and used up."""
        out, used = [], 1 << 40
        while True:
            rank, *parts = self.made.get(token, (-1, None, None))
            out.append((token, rank, used))
            if rank < 0:
                return tuple(out)
            token, used = parts[side], rank

    def _class(self, token: int) -> int:
        known = self.class_of.get(token)
        if known is None:
            edge = tuple(n for n in self._edge(token, 1) if n[0] in self.opens)
            known = self.class_of[token] = self.classes.setdefault(edge, len(self.classes))
            if known == len(self.edges):
                self.edges.append(edge)
        return known

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether a token of class ``left`` and the token ``right`` stay apart."""
        if not left:
            return True
        known = self.pairs.get((left, right))
        if known is None:
            edge = self.left_edges.get(right)
            if edge is None:
                edge = self.left_edges[right] = self._edge(right, 0)
            merges, known = self.vocabulary.merges, True
            for a, a_made, a_used in self.edges[left]:
                for b, b_made, b_used in edge:
                    merged = merges.get((a, b))
                    # of equal ranks the merge further left comes first
                    if merged and a_made < merged[0] < a_used and b_made < merged[0] <= b_used:
                        known = False
            self.pairs[left, right] = known
        return known

    def move(self, state: int, symbol: int) -> tuple[int, int]:
        """Next state and token gain; compiles the transition where it is new."""
        key = state * 512 + symbol
        known = self.moves.get(key)
        if known is not None:
            return known
        running, ended = [], None
        for node, left, count in self.states[state]:
            node = self.children[node].get(symbol)
            if node is None:
                continue
            token = self.closed[node]
            if ended is None and token is not None and self._neighbours(left, token):
                ended = (token, count + 1)
            if symbol < 256 and self.children[node]:
                running.append((node, left, count))
        if ended is None:
            raise ValueError(f"symbol {symbol} has no token")
        token, gain = ended
        target = 0
        if symbol < 256:  # else the word is over
            target = self._state((*((node, left, count - gain) for node, left, count in running), (0, self._class(token), 0)))
        self.moves[key] = (target, gain)
        self.new.append(key)
        return target, gain

    def _state(self, items: tuple) -> int:
        target = self.number.setdefault(items, len(self.states))
        if target == len(self.states):
            self.states.append(items)
        return target

    def _merge_new(self) -> None:
        """Sort what was compiled since into the arrays."""
        if self.new:
            keys = np.array(sorted(self.new), np.int64)
            found = np.array([self.moves[k] for k in keys.tolist()], np.int64)
            at = np.searchsorted(self.keys, keys)
            self.keys, self.targets, self.gains = (np.insert(x, at, y) for x, y in zip((self.keys, self.targets, self.gains), (keys, found[:, 0], found[:, 1])))
            self.new = []

    def walk(self, word: list[int], state: int = 0) -> int:
        """Tokens of the rest of one word, symbol by symbol."""
        total = 0
        for symbol in word:
            state, gain = self.move(state, symbol)
            total += gain
            if len(self.states) > MAX_STATES:
                items = self.states[state]
                self.reset()
                state = self._state(items)
        return total

    def count(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of the words at ``starts`` in ``data``, stepping through all of them together.

        A word that meets a transition not compiled yet, and a long word, is walked on its own.
        """
        def symbols(at: int, step: int = 0) -> list[int]:
            word = data[starts[at] + step:starts[at] + sizes[at]].tolist()
            word[-1] += 256
            return word

        out = np.zeros(len(starts), np.int64)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] <= LONG_WORD]
        state, step, alone = np.zeros(len(order), np.int64), 0, []
        while len(order):
            ends = sizes[order] == step + 1
            key = state * 512 + data[starts[order] + step] + 256 * ends
            where = np.searchsorted(self.keys, key)
            where[where == len(self.keys)] = 0
            known = self.keys[where] == key if len(self.keys) else np.zeros(len(key), bool)
            alone += zip(order[~known].tolist(), state[~known].tolist(), [step] * int((~known).sum()))
            order, where, ends = order[known], where[known], ends[known]
            out[order] += self.gains[where]
            state, order = self.targets[where][~ends], order[~ends]
            step += 1
        words: dict[tuple, int] = {}
        resets = self.resets
        for at, state, step in alone:
            if self.resets != resets:  # a walk has dropped the states: start from the word's own start
                state, step, out[at] = 0, 0, 0
            rest = (state, data[starts[at] + step:starts[at] + sizes[at]].tobytes())
            if rest not in words:
                words[rest] = self.walk(symbols(at, step), state)
            out[at] += words[rest]
        for at in np.flatnonzero(sizes > LONG_WORD):
            out[at] = self.walk(symbols(at))
        self._merge_new()
        return out


def encode_symbols(tokens: list[int], merges: dict) -> list[int]:
    """Apply the merges of lowest rank first."""
    while len(tokens) > 1:
        best = min(range(len(tokens) - 1), key=lambda i: merges.get((tokens[i], tokens[i + 1]), (1 << 40,))[0])
        merged = merges.get((tokens[best], tokens[best + 1]))
        if merged is None:
            break
        tokens[best:best + 2] = [merged[1]]
    return tokens


class Counter:
    """A vocabulary's machines in one task."""

    def __init__(self, vocabulary: Vocabulary):
        self.machine = MergeMachine(vocabulary)
        self.classes = np.frombuffer(vocabulary.classes, np.uint8)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        parts = json.loads(vocabulary.normalizer)["normalizers"]
        made = {"NFC": normalizers.NFC, "Lowercase": normalizers.Lowercase}
        self.library = normalizers.Sequence([made[p["type"]]() for p in parts if p["type"] in made])

    def plain(self, text: str) -> str:
        """Composed and in lower case, letter by letter; white space stays as it is, for no word holds any.

        Letters that this Python's tables do not know yet are left to the library's newer ones.
        """
        if text.isascii():
            return text.lower()
        if any(unicodedata.category(x) == "Cn" for x in set(text)):
            return self.library.normalize_str(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        pieces, owners, held = [], [], 0
        for at, text in enumerate(texts):
            if not text:
                continue
            if self.special is not None and "<" in text:
                text, found = self.special.subn(" ", text)
                out[at] += found
            for piece in slices(text):
                pieces.append(self.plain(piece))
                owners.append(at)
                held += len(pieces[-1])
                if held >= SLICE_CHARS:
                    self._count_pieces(pieces, owners, out)
                    pieces, owners, held = [], [], 0
        if pieces:
            self._count_pieces(pieces, owners, out)
        return out

    def _count_pieces(self, pieces: list[str], owners: list[int], out: np.ndarray) -> None:
        text = " ".join(pieces) + " "
        data = np.frombuffer(text.encode(), np.uint8)
        points = data if text.isascii() else np.frombuffer(text.encode("utf-32-le"), "<u4")
        classes = self.classes[points]
        begins = word_starts(classes)
        chars = np.flatnonzero(begins)
        # a word ends where the next begins or, before that, at white space
        stops = np.flatnonzero(begins | (classes == SPACE))
        ends = stops[np.searchsorted(stops, chars, side="right")]
        owner = np.array(owners)[np.searchsorted(np.cumsum([len(p) + 1 for p in pieces]), chars, side="right")]
        if points is not data:
            place = np.zeros(len(points) + 1, np.int64)
            np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=place[1:])
            chars, ends = place[chars], place[ends]
        np.add.at(out, owner, self.machine.count(data, chars, ends - chars))


_SPACES = regex.compile(r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """Pieces of about ``size`` characters, each cut before white space."""
    start = 0
    while len(text) - start > size:
        space = _SPACES.search(text, start + size)
        if space is None:
            break
        yield text[start:space.start()]
        start = space.start()
    yield text[start:] if start else text


_kept: list[tuple[Vocabulary, Counter]] = []


def kept_counter(vocabulary: Vocabulary) -> Counter:
    """The machines of the last vocabulary, which a reused worker process goes on with."""
    if not _kept or _kept[0][0] is not vocabulary:
        _kept[:] = [(vocabulary, Counter(vocabulary))]
    return _kept[0][1]


def count(df: DataFrame, vocabulary: Vocabulary, limit: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: over the limit are texts of more than ``limit`` tokens."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_counter(shared.value)
        for block in text_blocks(batches, "text"):
            tokens = counter.count(block.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("n_bytes"), pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"])

    rows = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
