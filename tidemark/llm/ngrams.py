"""Hashed n-grams of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: A word byte is a letter or digit of ASCII, or any byte beyond it; the rest become spaces. All digits count as 0.
WORD_TABLE = bytes(48 if chr(b) in "0123456789" else b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))

_MIX = np.random.default_rng(20240607).integers(1, 2**32, 256, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_STEP = np.uint32(0x9E3779B1)
_LAST = np.uint32(0x85EBCA6B)


def decoded(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def spaced_words(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All words of all texts in lower case, a space before each and one at the end; the number of words of each text."""
    parts = [decoded(t).lower().encode().translate(WORD_TABLE).split() for t in texts]
    joined = b" " + b"".join(b"".join((w, b" ")) for p in parts for w in p) if any(parts) else b""
    return np.frombuffer(joined, np.uint8), np.array([len(p) for p in parts], np.int64)


def code_points(data: np.ndarray) -> np.ndarray:
    """The characters of UTF-8 bytes."""
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def _mixed_points(points: np.ndarray) -> np.ndarray:
    h = points * np.uint32(0xCC9E2D51)
    h ^= h >> np.uint32(15)
    return h * np.uint32(0x1B873593) | np.uint32(1)


def gram_buckets(data: np.ndarray, sizes: Sequence[int], bits: int):
    """For each size, the bucket of the n-gram that starts at each byte, or code point (shorter at the end)."""
    mixed = _MIX[data] if data.dtype == np.uint8 else _mixed_points(data)
    h = np.zeros(len(data), np.uint32)
    for n in range(1, max(sizes) + 1):
        if n > len(data):
            break
        h = h[: len(data) - n + 1] * _STEP + mixed[n - 1 :]
        if n in sizes:
            yield n, ((h ^ np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF)) * _LAST) >> np.uint32(32 - bits)


def until_space(data: np.ndarray) -> np.ndarray:
    """Bytes from each place to the next space after it; data ends with a space."""
    places = np.flatnonzero(data == 32)
    here = np.arange(len(data))
    after = np.searchsorted(places, here, side="right")
    return np.where(after < len(places), places[np.minimum(after, len(places) - 1)] - here, 0)


_CLASS = np.array([0 if chr(b) in " \t\n\r\x0b\x0c" else 1 if b >= 0x80 or chr(b).isalnum() else 2 for b in range(256)], np.uint8)


def token_hashes(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every token (run of word bytes or run of symbols) of all texts, and the tokens of each text."""
    raw = [t or b"" for t in texts]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    kind = _CLASS[data]
    opens = kind != 0
    opens[1:] &= kind[1:] != kind[:-1]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(raw), np.int64)
    lengths = np.diff(starts, append=len(data))
    within = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = np.empty(int(lengths.max()), np.uint64)
    powers[0] = 1
    powers[1:] = np.uint64(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(powers)
    value = np.where(kind[starts[0] :] != 0, _MIX[data[starts[0] :]].astype(np.uint64) * powers[within], np.uint64(0))
    hashes = np.add.reduceat(value, starts - starts[0])
    ends = np.cumsum([len(t) + 1 for t in raw])
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run of `counts` values; 0 for empty runs."""
    out = np.zeros(len(counts), np.float64)
    full = counts > 0
    if full.any():
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))[full]
        out[full] = np.add.reduceat(values.astype(np.float64), starts)
    return out
