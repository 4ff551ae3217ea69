"""Words of many texts as numpy arrays, and 64-bit hashes of runs of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LETTER, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PIECE = 250_000  # bytes hashed at a time, which takes about 70 times as much


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Every bit of the result depends on every bit of the hash and the seed."""
    h = h + np.uint64(seed * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


class Rolling:
    """Polynomial hashes of slices of a sequence, from one pass of prefix sums."""

    def __init__(self, base: np.uint64):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def slices(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(values):
            n = 2 * len(values)
            self.up, self.down = powers(self.base, n), powers(_inverse(self.base), n)
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=prefix[1:])
        return mixed((prefix[ends] - prefix[starts]) * self.down[starts])


def canonical(text: str | None) -> bytes:
    """The words (separated by the six blanks) joined by single spaces."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


class WordHasher:
    def __init__(self):
        self.letters, self.steps = Rolling(LETTER), Rolling(STEP)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word of all texts in order, number of words of each text)."""
        counts = np.array([t.count(b" ") + 1 if t else 0 for t in texts], dtype=np.int64)
        whole = np.frombuffer(b" ".join(t for t in texts if t), np.uint8)
        if not len(whole):
            return np.zeros(0, np.uint64), counts
        gaps = np.flatnonzero(whole == 32)
        starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(whole)]])
        return self.letters.slices(whole.astype(np.uint64) + np.uint64(1), starts, ends), counts

    def runs(self, words: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from each place on; shorter than words by n - 1."""
        at = np.arange(max(0, len(words) - n + 1))
        return self.steps.slices(words, at, at + n)


def pieces(texts: list[bytes], most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes; a longer text is a range of its own."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values."""
    if len(values) < n:
        return values[:0]
    width, out = 1, values
    while 2 * width <= n:
        out = np.minimum(out[: len(out) - width], out[width:])
        width *= 2
    rest = n - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
