"""Word shingles of byte texts as 64-bit numbers, by numpy over whole buffers."""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes that are hashed at once. Longer texts are cut at white space; hashes of words do not depend on the cut.
SLICE = 1 << 18
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
WINDOW = 5


def _fixed(label: str, n: int) -> np.ndarray:
    """Numbers that are the same in every process."""
    raw = b"".join(hashlib.blake2b(f"{label} {i}".encode(), digest_size=8).digest() for i in range(n))
    return np.frombuffer(raw, dtype="<u8").copy()


BYTE_VALUES = _fixed("byte", 256)
BASE = _fixed("base", 1)[0] | np.uint64(1)
PLACES = _fixed("place", 16) | np.uint64(1)
# A little longer than a slice, for callers whose slices overlap.
POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(SLICE + 1024, BASE, dtype=np.uint64))])
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
INVERSE_POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(SLICE + 1024, INVERSE, dtype=np.uint64))])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over all places (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """One number per word (a run without ASCII white space), equal for equal words."""
    if len(data) > SLICE:
        out, start = [], 0
        while start < len(data):
            end = min(len(data), start + SLICE)
            if end < len(data):
                cut = max(data.rfind(bytes([b]), start, end) for b in (0x20, 0x0A, 0x09, 0x0B, 0x0C, 0x0D))
                if cut > start:
                    end = cut
                else:  # one word longer than a slice: hashed by itself
                    rest = [p for p in (data.find(bytes([b]), start) for b in (0x20, 0x0A, 0x09, 0x0B, 0x0C, 0x0D)) if p >= 0]
                    end = min(rest, default=len(data))
                    end = max(end, start + 1)
            part = data[start:end]
            out.append(_long_word(part) if len(part) > SLICE else _word_hashes(part))
            start = end
        return np.concatenate(out) if out else np.zeros(0, np.uint64)
    return _word_hashes(data)


def _long_word(word: bytes) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), dtype="<u8").copy()


def _word_hashes(data: bytes) -> np.ndarray:
    letters = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(letters) + 2, dtype=bool)
    inside[1:-1] = ~SPACES[letters]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[letters] * POWERS[: len(letters)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * INVERSE_POWERS[starts] + PLACES[15] * (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, window: int = WINDOW) -> np.ndarray:
    """The sorted distinct shingles of a text in lower case (A to Z alone); fewer words than a window count as one."""
    if not text:
        return np.zeros(0, np.uint64)
    words = word_hashes(text.encode().lower())
    n = len(words)
    if n == 0:
        return words
    if n < window:
        parts = np.concatenate([words * PLACES[:n], PLACES[14:15] * np.array([n], dtype=np.uint64)])
        return mixed(parts.sum(keepdims=True, dtype=np.uint64))
    total = words[: n - window + 1] * PLACES[0]
    for step in range(1, window):
        total += words[step : n - window + 1 + step] * PLACES[step]
    total = np.sort(mixed(total + PLACES[13]))
    return total[np.concatenate([[True], total[1:] != total[:-1]])]
