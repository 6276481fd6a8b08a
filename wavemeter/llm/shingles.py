"""Words and word shingles of texts as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

from wavemeter.llm.workers import hold

SIZE = 5
# Word hashes a worker remembers before it starts afresh; a matter of speed alone.
KNOWN_WORDS = 250_000
_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_known = _Known()


def mix(values: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit numbers (the finaliser of splitmix64)."""
    x = values + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


# Odd multipliers of the words of a shingle by place.
_PLACES = mix(np.arange(1, SIZE + 1, dtype=np.uint64)) | np.uint64(1)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case. Bytes split at ASCII white space alone."""
    hold("word hashes", _known.clear)
    words = (text or "").encode().lower().split()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hash of every run of ``SIZE`` words, in order; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return words
    size = min(SIZE, n)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out += words[i : n - size + 1 + i] * _PLACES[i]
    return mix(out)


def shingle_lists(texts: Iterable[str | None]) -> list[np.ndarray]:
    """The shingles of many texts; they are hashed together, as short arrays cost most in calls."""
    words = [word_hashes(text) for text in texts]
    if not words:
        return []
    together = shingles(np.concatenate(words))
    out, start = [], 0
    for own in words:
        n = len(own)
        out.append(together[start : start + n - SIZE + 1] if n >= SIZE else shingles(own))
        start += n
    return out


def shingle_sets(texts: Iterable[str | None]) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending."""
    return [np.unique(own) for own in shingle_lists(texts)]


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingles(word_hashes(text)))


def in_groups(texts: Iterable, most: int = 1_000_000, by: int = 1) -> Iterator[tuple[int, list]]:
    """(first place, texts) of neighbours with so many characters together, or one longer text;
    ``by`` neighbours always stay together."""
    start, held, out = 0, 0, []
    for i, text in enumerate(texts):
        text = text.as_py()
        if out and held + len(text or "") > most and len(out) % by == 0:
            yield start, out
            start, held, out = i, 0, []
        held += len(text or "")
        out.append(text)
    if out:
        yield start, out
