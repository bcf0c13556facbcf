"""Word and shingle hashing with numpy, a batch of texts at a time.

A word's hash is a polynomial in its bytes modulo 2**64, taken for all words at once from one running sum; a
shingle's hash mixes the hashes of its words. Two different words or shingles share a 64-bit hash with a chance
of about 5e-20, so a set of hashes stands for the set itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
PIECE_BYTES = 1 << 20

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        held = np.cumprod(steps, dtype=np.uint64)
        if n <= PIECE_BYTES + 1:
            _powers[base] = held
    return held[:n]


def normalise(text: str | None) -> bytes:
    """Lower-case A-Z and put one space between words ``[^\\x20\\x09-\\x0D]+``; bytes.split cuts at just these."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def _hash_piece(data: bytes) -> np.ndarray:
    """Hash of each word of ``data``, in which words are parted by single spaces."""
    if not data:
        return np.empty(0, np.uint64)
    buf = np.frombuffer(data, np.uint8)
    spaces = np.flatnonzero(buf == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.concatenate((spaces, [len(buf)]))
    terms = _BYTE[buf]
    terms *= _power(_BASE, len(buf))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    value = (total[ends] - total[starts]) * _power(_BASE_INVERSE, len(buf) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64))


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at spaces into pieces of about PIECE_BYTES; a longer word stays whole."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        cut = data.rfind(b" ", at, at + PIECE_BYTES)
        if cut <= at:
            cut = data.find(b" ", at + PIECE_BYTES)
            if cut < 0:
                break
        yield data[at:cut]
        at = cut + 1
    yield data[at:]


def word_hashes(normalised: list[bytes]) -> list[np.ndarray]:
    """Word hashes of each normalised text. Give texts of about PIECE_BYTES in all; a longer one is cut up."""
    long_one = len(normalised) == 1 and len(normalised[0]) > PIECE_BYTES
    if long_one:
        return [np.concatenate([_hash_piece(p) for p in _pieces(normalised[0])])]
    counts = [t.count(b" ") + 1 if t else 0 for t in normalised]
    flat = _hash_piece(b" ".join(t for t in normalised if t))
    return np.split(flat, np.cumsum(counts)[:-1]) if counts else []


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, in order; empty if there are fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * _PLACE[0]
    for k in range(1, width):
        total = total + words[k : k + n] * _PLACE[k]
    return mix(total + np.uint64(width))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Five-word shingles in order; fewer words make one shingle of the whole sequence, none make none."""
    if 0 < len(words) < WIDTH:
        return window_hashes(words, len(words))
    return window_hashes(words, WIDTH)


def min_max(shingles: np.ndarray, keys: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of the shingles' upper halves under each permutation ``(x ^ key) * factor``."""
    low = np.full(len(keys), np.iinfo(np.uint32).max, np.uint32)
    high = np.zeros(len(keys), np.uint32)
    upper = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(upper), 2048):
        values = (upper[i : i + 2048, None] ^ keys) * factors
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return low, high


def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**32, n, dtype=np.uint32), rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)
