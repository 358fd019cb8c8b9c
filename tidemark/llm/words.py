"""Words, word hashes and word-window hashes of a text, as whole-array numpy steps.

A word is a maximal run of bytes other than space and 0x09-0x0D of the UTF-8 text. Hashes are
64 bits of a polynomial over random byte values, mixed. Long texts are taken in slices cut at
white space, so that memory stays bounded by the slice.
"""

from __future__ import annotations

import numpy as np

SLICE = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_SEED = np.random.default_rng(20240607)
_BYTE = _SEED.integers(1, 2 ** 64, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_WINDOW = _SEED.integers(1, 2 ** 64, 64, dtype=np.uint64) | np.uint64(1)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("_powers", _BASE), ("_inverses", inverse)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans(raw: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; ``gap`` tells for each byte whether it separates."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~gap[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _slices(raw: np.ndarray, gap: np.ndarray):
    """(start, end) of slices of about ``SLICE`` bytes that end before a gap, so that no word
    is cut."""
    at = 0
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        while end < len(raw):
            found = np.flatnonzero(gap[raw[end:end + SLICE]])
            if len(found):
                end += int(found[0])
                break
            end = min(end + SLICE, len(raw))
        yield at, end
        at = end


def hashed_words(text: bytes, lower: bool = False, gap: np.ndarray = _SPACE
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word, in order; ``lower`` treats A-Z as a-z."""
    values = _BYTE_LOWER if lower else _BYTE
    raw = np.frombuffer(text, np.uint8)
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at, end in _slices(raw, gap):
        piece = raw[at:end]
        start, stop = spans(piece, gap)
        _grow(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * _powers[:len(piece)], out=sums[1:])
        hashes = mix((sums[stop] - sums[start]) * _inverses[start]
                     + (stop - start).astype(np.uint64))
        parts.append((hashes, start + at, stop + at))
    if len(parts) == 2:
        return parts[1]
    return tuple(np.concatenate(column) for column in zip(*parts))


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    return hashed_words(text, lower)[0]


def word_hashes_between(text: bytes, gap: np.ndarray) -> np.ndarray:
    """Hashes of words in lower case (A-Z), separated by the bytes that ``gap`` marks."""
    return hashed_words(text, True, gap)[0]


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` consecutive words; none for fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += words[i:i + n] * _WINDOW[i]
    return mix(total)


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a lower-cased text: windows of ``width`` words, the
    whole word sequence where it is shorter, nothing without words."""
    words = word_hashes(text, lower=True)
    if 0 < len(words) < width:
        return window_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(window_hashes(words, width))
