"""Words and word shingles of a text as 64-bit hashes, in numpy."""

from hashlib import blake2b

import numpy as np

#: Entries after which a task's table of word hashes starts anew.
TABLE_LIMIT = 400_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; each word is hashed once."""

    limit = TABLE_LIMIT

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


class LineHashes(WordHashes):
    """The same for lines, which are longer and repeat less."""

    limit = 40_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(width: int) -> np.ndarray:
    steps = np.arange(1, width + 1, dtype=np.uint64)
    return mixed(steps * _GOLDEN) | np.uint64(1)


def word_hashes(text: bytes | None, table: WordHashes, lower: bool = True) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+``; A-Z count as a-z when ``lower``.

    ``bytes.lower`` and ``bytes.split`` know exactly these letters and these blanks.
    """
    if not text:
        return np.empty(0, np.uint64)
    words = (text.lower() if lower else text).split()
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` words, in text order; fewer words are one run."""
    n = len(words)
    if not n:
        return words
    factors = multipliers(width)
    if n < width:
        whole = (mixed(words + factors[:n]) * factors[:n]).sum(dtype=np.uint64)
        return mixed(np.array([whole ^ np.uint64(n)], np.uint64))
    spread = mixed(words)
    total = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        total += spread[i : n - width + 1 + i] * factors[i]
    return mixed(total)
