"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The vocabulary is that of a public tokenizer file (its path is a parameter).
Spark counts the corpus' words; the most frequent ones are encoded once and
compiled into a minimal acyclic transducer: an automaton over the words'
bytes whose states share prefixes and suffixes and whose transitions put out
token ids, as early as all words that pass them agree.  The transducer is a
flat byte string of bounded size; it is broadcast, and each Python worker
maps it into memory.  Words that it does not hold are merged exactly, pair by
pair, by rank.

Defined results: NULL text counts as empty; an empty text has no tokens and
decodes to the empty text; rows that repeat an id give a row each; NULL ids
give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty

LEXICON_WORDS = 32_768
#: Words, and pieces of text between blanks, that a worker remembers in each of two generations.
WORD_MEMO, PIECE_MEMO = 220_000, 80_000
#: Word pieces that a task counts before it passes them on.
COUNT_FLUSH = 300_000
#: Longer words are not put into the lexicon (they are merged like any other unseen word), so its size is bounded.
LONGEST = 256
#: Longer words are merged by a heap.
SHORT = 48
#: What the tokenizer file's format fixes: how words are found, and the mark of a word's end.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"
BYTES = [bytes([b]) for b in range(256)]
#: Characters that str.split() takes for white space and the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Token ids, merge ranks and added tokens of a tokenizer file with word ends."""

    def __init__(self, raw: str):
        spec = json.loads(raw)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.bits = max(self.ids.values(), default=0).bit_length()
        #: Of each pair of ids that merges: its rank and the id of what it becomes, in one integer that is ordered by rank.
        self.merges = {
            self.ids[a] << self.bits | self.ids[b]: rank << self.bits | self.ids[a + b]
            for rank, (a, b) in enumerate(spec["model"]["merges"])}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for token, i in [*self.ids.items(), *self.added.items()]:
            self.tokens[i] = token
        self.mask, self.none = (1 << self.bits) - 1, len(spec["model"]["merges"]) << self.bits
        chars = byte_chars()
        #: Ids of the bytes within a word and at its end; a byte that the file lacks fails the word that has it.
        self.first = {b: self.ids[c] for b, c in enumerate(chars) if c in self.ids}
        self.last = {b: self.ids[c + END] for b, c in enumerate(chars) if c + END in self.ids}
        self.special = re.compile("|".join(map(re.escape, self.added))) if self.added else None

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word: of all neighbouring pairs the one with the lowest rank, then leftmost, merges first."""
        parts = [*map(self.first.__getitem__, word[:-1]), self.last[word[-1]]]
        return self._merged_short(parts) if len(parts) <= SHORT else self._merged_long(parts)

    def _merged_short(self, parts: list[int]) -> list[int]:
        """By looking at all ranks for each merge."""
        merge, bits, none = self.merges.get, self.bits, self.none
        ranks = [merge(a << bits | b, none) for a, b in pairwise(parts)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i] = made = least & self.mask
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = merge(made << bits | parts[i + 1], none)
            if i:
                ranks[i - 1] = merge(parts[i - 1] << bits | made, none)
        return parts

    def _merged_long(self, parts: list[int | None]) -> list[int]:
        """By a heap of pairs."""
        merge, bits = self.merges.get, self.bits
        right, left = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(pairwise(parts)) if (r := merge(a << bits | b)) is not None]
        heapq.heapify(heap)
        while heap:
            made, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue  # one of the two has merged with another since
            parts[i], parts[j], right[i] = made & self.mask, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] >= 0 and (r := merge(parts[k] << bits | parts[right[k]])) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[right[k]]))
        return [p for p in parts if p is not None]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens of ``ids`` joined by spaces: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def normalised(text: str) -> str:
    """NFC, then each character's own lower case (a final sigma is no special case)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def _words(piece: str) -> list[str]:
    """The words of a piece; one of ASCII letters alone is its only word."""
    return [piece] if piece.isascii() and piece.isalpha() else WORD.findall(piece)


def _pieces(text: str) -> list[str]:
    return text.split() if not SEPARATORS.search(text) else regex.findall(r"\S+", text)


# -- the transducer ---------------------------------------------------------------------------------------------------


def _common(a: Sequence[int], b: Sequence[int]) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


class _State:
    __slots__ = ("arcs", "final", "out")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte -> [target, ids put out]
        self.final = False
        self.out: tuple[int, ...] = ()  # put out at the word's end


def compile_transducer(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The minimal acyclic transducer of (word, ids) pairs with different non-empty words, as a flat byte string.

    Words are taken in order; once no later word can pass a state, it is
    replaced by an equal one if there is any (shared suffixes).
    """
    root, register, order = _State(), {}, []
    path, previous = [root], b""

    def close(down_to: int) -> None:
        while len(path) - 1 > down_to:
            state = path.pop()
            key = (state.final, state.out, tuple((c, a[0], a[1]) for c, a in sorted(state.arcs.items())))
            if key not in register:
                register[key] = len(order)
                order.append(state)
            path[-1].arcs[previous[len(path) - 1]][0] = register[key]

    for word, ids in sorted((w, tuple(i)) for w, i in entries):
        same = _common(word, previous)
        close(same)
        rest = ids
        for depth in range(same):  # what the arc puts out is what all its words share; the remainder moves on
            arc, below = path[depth].arcs[word[depth]], path[depth + 1]
            n = _common(arc[1], rest)
            moved, arc[1], rest = arc[1][n:], arc[1][:n], rest[n:]
            if moved:
                for a in below.arcs.values():
                    a[1] = moved + a[1]
                if below.final:
                    below.out = moved + below.out
        for c in word[same:]:
            path[-1].arcs[c] = [None, rest]
            rest = ()
            path.append(_State())
        path[-1].final, path[-1].out = True, rest
        previous = word
    close(0)
    order.append(root)

    pool: list[int] = []
    places: dict[tuple[int, ...], int] = {(): 0}

    def place(out: tuple[int, ...]) -> tuple[int, int]:
        if out not in places:
            places[out] = len(pool)
            pool.extend(out)
        return places[out], len(out)

    labels, targets, outs, first, finals = bytearray(), [], [], [0], []
    for state in order:
        for c, (target, out) in sorted(state.arcs.items()):
            labels.append(c)
            targets.append(target)
            outs.extend(place(out))
        first.append(len(labels))
        finals.extend((int(state.final), *place(state.out)))
    sizes = [len(order), len(labels), len(pool)]
    ints = [np.array(x, np.uint32).tobytes() for x in (first, targets, outs, finals, pool)]
    return b"".join([struct.pack("<3I", *sizes), *ints, bytes(labels)])


class Transducer:
    """Looks words up in a compiled transducer that is mapped into memory."""

    def __init__(self, raw: bytes):
        with tempfile.TemporaryFile() as f:  # has no name, so nothing stays behind
            f.write(raw)
            f.flush()
            self.map = mmap.mmap(f.fileno(), len(raw), access=mmap.ACCESS_READ)
        n_states, n_arcs, n_pool = struct.unpack_from("<3I", self.map)
        view, at, parts = memoryview(self.map), 12, []
        for n in (n_states + 1, n_arcs, 2 * n_arcs, 3 * n_states, n_pool):
            parts.append(view[at:at + 4 * n].cast("I"))
            at += 4 * n
        self.first, self.targets, self.outs, self.finals, self.pool = parts
        self.labels, self.root = at, n_states - 1

    def get(self, word: bytes) -> list[int] | None:
        """The word's ids, or None if the lexicon does not hold it."""
        state, out = self.root, []
        find, labels, first, targets, outs = self.map.find, self.labels, self.first, self.targets, self.outs
        for c in word:
            a = find(BYTES[c], labels + first[state], labels + first[state + 1])
            if a < 0:
                return None
            arc = a - labels
            if n := outs[2 * arc + 1]:
                at = outs[2 * arc]
                out.extend(self.pool[at:at + n])
            state = targets[arc]
        final, at, n = self.finals[3 * state:3 * state + 3]
        if not final:
            return None
        out.extend(self.pool[at:at + n])
        return out


class _Recent(dict):
    """Values by key: of those used lately ``limit`` to twice as many are remembered, others are made again."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes whole texts: pieces and words that it remembers, words of the lexicon, exact merges, in this order."""

    def __init__(self, vocabulary: Vocabulary, transducer: Transducer | None = None):
        self.vocabulary, self.transducer = vocabulary, transducer
        self.words, self.pieces = _Recent(self._word, WORD_MEMO), _Recent(self._piece, PIECE_MEMO)

    def word(self, word: bytes) -> list[int]:
        found = self.transducer.get(word) if self.transducer else None
        return self.vocabulary.merged(word) if found is None else found

    def _word(self, word: str) -> bytes:
        ids = self.word(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.words.__getitem__, _words(piece)))

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _pieces(normalised(text))))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; added tokens in the text are found first."""
        special = self.vocabulary.special
        if special is None or not special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in special.finditer(text):
            out += [self._plain(text[at:m.start()]), struct.pack("<I", self.vocabulary.added[m[0]])]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])


# -- Spark ------------------------------------------------------------------------------------------------------------


def frequent_words(docs: DataFrame, n: int = LEXICON_WORDS, text_col: str = "text") -> list[str]:
    """At most ``n`` words of the corpus: those of the highest classes of frequency, counted over all whole texts.

    Tasks count and pass on partial sums, Spark adds them up; the driver gets
    a histogram of the counts and the chosen words only.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: Counter[str] = Counter()

        def sums() -> pd.DataFrame:
            words: Counter[str] = Counter()
            for piece, k in pieces.items():
                for w in _words(piece):
                    words[w] += k
            pieces.clear()
            return pd.DataFrame({"word": list(words), "n": list(words.values())})

        for pdf in batches:
            for text in pdf["text"]:
                pieces.update(_pieces(normalised(text)))
                if len(pieces) > COUNT_FLUSH:
                    yield sums()
        yield sums()

    parts = docs.select(text_or_empty(text_col).alias("text")).mapInPandas(counted, "word string, n long")
    counts = stage(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    # a histogram of the counts, 16 classes for each doubling, says from which class on at most n words are left
    size = F.floor(F.log2("n") * 16).cast("int").alias("size")
    classes = sorted(counts.groupBy(size).count().collect(), reverse=True)
    least, taken = None, 0
    for r in classes:
        if taken + r["count"] > n:
            break
        least, taken = r["size"], taken + r["count"]
    if least is None:
        return []
    return [r["word"] for r in counts.where((size >= least) & (F.length("word") <= LONGEST)).select("word").collect()]


def build_lexicon(vocabulary: Vocabulary, words: Iterable[str]) -> bytes:
    """The compiled transducer of the words' encodings."""
    return compile_transducer((w.encode(), vocabulary.merged(w.encode())) for w in words if w)


#: A worker process' last encoder, which its next task with the same files takes over with all it remembers.
_kept: dict[bytes, Encoder] = {}


def _worker_encoder(file: str, compiled: bytes) -> Encoder:
    key = hashlib.sha256(file.encode() + compiled).digest()
    if key not in _kept:
        _kept.clear()
        _kept[key] = Encoder(Vocabulary(file), Transducer(compiled))
    return _kept[key]


def encode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (little-endian unsigned 32-bit integers as binary), decoded."""
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = f.read()
    lexicon = build_lexicon(Vocabulary(raw), frequent_words(docs, lexicon_words, text_col))
    # both are bounded: by the tokenizer file and by the number of words in the lexicon
    shared = docs.sparkSession.sparkContext.broadcast((raw, lexicon))

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _worker_encoder(*shared.value)
        for pdf in batches:
            ids = [encoder.encode(t) for t in pdf["text"]]
            decoded = [encoder.vocabulary.decode(memoryview(x).cast("I")) for x in ids]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "ids": ids, "decoded": decoded})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return texts.mapInPandas(encoded, "doc_id long, ids binary, decoded string")
