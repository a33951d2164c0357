"""Array helpers for words of many texts at once (used inside Spark tasks).

A batch of texts is laid end to end as UTF-8 bytes; words, their hashes and
the hashes of word windows are then computed for the whole batch with numpy.
Hash tables come from a seeded generator, so every task agrees on them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Code points that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = b" \t\n\x0b\x0c\r"
#: Text handled in one numpy pass, in bytes (a longer text makes one pass of its own).
PASS_BYTES = 1 << 21

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, lane: int) -> np.ndarray:
    return np.random.default_rng([7, lane]).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _byte_table(lane: int) -> np.ndarray:
    return np.random.default_rng([11, lane]).integers(0, 2**64, 256, dtype=np.uint64)


def _blank_table() -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(BLANKS)] = True
    return t


def _place_factors(n: int, lane: int) -> np.ndarray:
    size = 64
    while size < n:
        size *= 2
    return odd_numbers(size, 100 + lane)


@dataclass
class Words:
    """``data``: bytes of all texts; ``start``/``end``: byte range of each word; ``bounds``: first word of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.count)

    def hashes(self, lane: int = 0) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        lens = self.end - self.start
        total = int(lens.sum())
        first = np.cumsum(lens) - lens
        place = np.arange(total) - np.repeat(first, lens)
        values = _byte_table(lane)[self.data[place + np.repeat(self.start, lens)]]
        values *= _place_factors(int(lens.max()), lane)[place]
        sums = np.add.reduceat(values, first)
        return mix(sums + lens.astype(np.uint64))


def words_of(texts: list[str | None]) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; a null text has none."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    inside = ~_blank_table()[data]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    start, end = edge[0::2], edge[1::2]
    sizes = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    text_start = np.concatenate([[0], np.cumsum(sizes)])
    return Words(data, start, end, np.searchsorted(start, text_start))


def window_hashes(word_hashes: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of ``length`` words, as if all texts were one (mask with ``whole_windows``)."""
    n = len(word_hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    factors = odd_numbers(64 * (1 + length // 64), 200 + lane)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(length):
        out += word_hashes[j : j + n] * factors[j]
    return mix(out)


def whole_windows(bounds: np.ndarray, length: int) -> np.ndarray:
    """Which of the runs in ``window_hashes`` lie inside one text."""
    total = int(bounds[-1])
    n = max(0, total - length + 1)
    last = np.repeat(bounds[1:], np.diff(bounds))[:n]
    return np.arange(n) + length <= last


def sliding(values: np.ndarray, width: int, op=np.minimum) -> np.ndarray:
    """``op`` over each run of ``width`` values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have, out = 1, values
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def slices(sizes, limit: int = PASS_BYTES):
    """Ranges of consecutive texts of about ``limit`` bytes together; no text is cut."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)
