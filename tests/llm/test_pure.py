"""The parts of the operators that need no Spark."""

import os
import random

import numpy as np
import pytest

from lakeward.llm import bagminhash as bmh
from lakeward.llm import bpe, exact_dedup, toxicity, topk
from lakeward.llm.words import hashes, mixed

TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_chunk_hashes_compose_to_the_whole_texts_hash():
    p, q = exact_dedup.PRIMES
    body = os.urandom(1000)
    whole = exact_dedup.chunk_hash(body, 0)
    for size in (1, 7, 64, 999, 1000):
        parts = [exact_dedup.chunk_hash(body[i:i + size], max(0, len(body) - i - size)) for i in range(0, len(body), size)]
        assert (sum(a for a, _ in parts) % p, sum(b for _, b in parts) % q) == whole


def test_signatures_estimate_weighted_jaccard_without_bias():
    rng = random.Random(1)
    keys = np.unique(mixed(np.arange(60, dtype=np.uint64)))
    for _ in range(3):
        a = np.array([rng.choice([1, 1, 2, 3, 5, 9]) for _ in keys])
        b = np.array([rng.choice([1, 1, 2, 3, 6, 8]) for _ in keys])
        s = bmh.signatures([(keys, a), (keys, b)], 20_000)
        assert abs((s[0] == s[1]).mean() - bmh.similarity((keys, a), (keys, b))) < 0.015


def test_signature_does_not_depend_on_its_batch():
    bags = [bmh.shingles(hashes([f"w{i * j % 13}" for i in range(40)])) for j in range(1, 6)]
    together = bmh.signatures(bags, 120)
    for bag, row in zip(bags, together):
        assert (bmh.signatures([bag], 120)[0] == row).all()


def test_shingles_of_short_texts():
    assert len(bmh.shingles(hashes([]))[0]) == 1
    one, two = bmh.shingles(hashes(["a"])), bmh.shingles(hashes(["a", "b"]))
    assert len(one[0]) == len(two[0]) == 1 and one[0][0] != two[0][0]
    assert bmh.shingles(hashes(["x"] * 9))[1].tolist() == [5]


@pytest.fixture(scope="module")
def vocabulary():
    with open(TOKENIZER, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


ODD = [
    "", "  ", "it's 12 don't I'LL x<|endoftext|>y <|STARTOFTEXT|>", "ΣΑΣ ΌΣΟΣ İstanbul ǅ ﬁ", "a\x1cb\x85c d​e　f",
    "日本語テキスト 🤣🤣 é ẞ", "x" * 3000, "''''s'S 'tt", "\x00\x01 ퟿ ﷺ Å K", "12345 ½ Ⅷ ²",
    "<|startoftext|><|endoftext|>", "Café CAFÉ café",
]


def test_encoding_equals_the_tokenizers_library(vocabulary):
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(TOKENIZER)
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("abc eé'1!Σ ß\n") for _ in range(200)) for _ in range(100)]
    words = ["it", "the", "abc", "a", "café", "e", "x" * 30, "日本語"]
    encoder = bpe.Encoder(vocabulary, bpe.Transducer(bpe.build_lexicon(vocabulary, words)))
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == expected, text[:50]
        assert vocabulary.decode(ids) == tokenizer.decode(expected, skip_special_tokens=False)


def test_merges_go_by_ids_alone(vocabulary):
    assert all(type(pair) is int and type(made) is int for pair, made in vocabulary.merges.items())
    rng = random.Random(9)
    for n in (1, 2, 9, bpe.SHORT, 200):
        parts = [vocabulary.first[b] for b in rng.choices(b"aeinorst", k=n)]
        assert vocabulary._merged_short(parts[:]) == vocabulary._merged_long(parts[:])
    for piece in ("abc", "it's", "s", "a1", "\xe9t\xe9", "-", "'ll", "ab'"):
        assert bpe._words(piece) == bpe.WORD.findall(piece)


def test_transducer_holds_its_words_and_no_others():
    rng = random.Random(3)
    entries = {}
    for _ in range(3000):
        w = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 8))).encode()
        entries[w] = [rng.randint(0, 5) for _ in range(rng.randint(0, 4))]
    t = bpe.Transducer(bpe.compile_transducer(entries.items()))
    assert all(t.get(w) == ids for w, ids in entries.items())
    for _ in range(3000):
        w = "".join(rng.choice("abcde") for _ in range(rng.randint(0, 9))).encode()
        assert t.get(w) == entries.get(w)


def test_transducer_shares_suffixes():
    words = [f"{a}{b}ation".encode() for a in "abcdefgh" for b in "abcdefgh"]
    raw = bpe.compile_transducer((w, [1]) for w in words)
    states = int.from_bytes(raw[:4], "little")
    assert states <= 9  # one state each for the root, the two letters, and the shared ending


def test_empty_lexicon():
    assert bpe.Transducer(bpe.compile_transducer([])).get(b"a") is None


def test_ftrl_learns_a_sparse_separating_model():
    rng = random.Random(4)
    z, n, p = np.zeros(1 << 14), np.zeros(1 << 14), toxicity.Ftrl()
    rows = []
    for i in range(600):
        words = [f"w{rng.randint(0, 300)}" for _ in range(30)] + (["nasty"] if i % 3 == 0 else [])
        rows.append((np.unique(np.append(toxicity.features(" ".join(words), 14), 0)), int(i % 3 == 0)))
    for _ in range(4):
        for idx, label in rows:
            toxicity.learn(z, n, idx, label, p)
    w = toxicity.weights_of(z, n, p)
    assert sum((w[idx].sum() >= 0) == (label == 1) for idx, label in rows) >= 590
    assert (w != 0).sum() < 0.2 * (n > 0).sum()


def test_tile_selection_matches_sorting_with_ties():
    rng = np.random.default_rng(5)
    q, c = rng.integers(-2, 3, (7, 4)), rng.integers(-2, 3, (50, 4))
    ids = np.arange(50) * 3
    got = topk._best(q, ids[:7], c, ids, 10)
    for i in range(7):
        expected = sorted((-int(q[i] @ c[j]), int(ids[j])) for j in range(50) if ids[j] != ids[i])[:10]
        mine = got[got["query_id"] == ids[i]]
        assert list(zip((-mine["score"]).tolist(), mine["vec_id"].tolist())) == expected
    big = topk._best(q * (1 << 40), ids[:7], c * (1 << 15), ids, 10)
    assert big["vec_id"].tolist() == got["vec_id"].tolist()
