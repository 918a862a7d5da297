"""Words of a text and their hashes, for code that runs inside tasks."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
#: Words whose hashes a worker process remembers.
MEMO = 300_000


class _Hashes(dict):
    """Words and their 62-bit hashes, worked out once a process for the words it meets often."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 2
        return out


_hashes = _Hashes()


def words(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return WORD.findall(text.lower())


def hashes(found: list[str]) -> np.ndarray:
    """The words' hashes as unsigned 64-bit integers."""
    return np.array(list(map(_hashes.__getitem__, found)), np.int64).view(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
