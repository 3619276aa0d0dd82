"""Word shingles as sorted sets of hashes, and their MinHash signatures."""

from __future__ import annotations

import numpy as np
import xxhash

from foldcast.llm.common import hashed_words, mix

SHINGLE_WORDS = 5
#: MinHash values of a signature: BANDS bands of BAND_ROWS.
BANDS, BAND_ROWS = 32, 5
SIGNATURE = BANDS * BAND_ROWS
_RANDOM = np.random.default_rng(20240501)
_SCALE = (_RANDOM.integers(0, 1 << 32, SIGNATURE, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_SHIFT = _RANDOM.integers(0, 1 << 32, SIGNATURE, dtype=np.uint64).astype(np.uint32)


def shingle_sets(flat: np.ndarray, begins: np.ndarray, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The distinct shingles of each row, sorted; a row of fewer words has one shingle, a row of none has none."""
    hashes, index = hashed_words(flat, begins)
    step = np.uint64(0x9E3779B97F4A7C15)
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for k in range(min(words, n)):
        rolled[: n - k] = rolled[: n - k] * step + hashes[k:]
        if k:
            rolled[n - k :] = 0
    rolled = mix(rolled)
    out = []
    for a, b in zip(index[:-1], index[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh64_intdigest(hashes[a:b].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(shingles.tobytes())


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set that is not empty; long sets go through in pieces."""
    out = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    for at in range(0, len(short), 1024):
        x = short[at : at + 1024]
        values = _SCALE[:, None] * x + _SHIFT[:, None]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        values ^= values >> np.uint32(13)
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature (rows x BANDS)."""
    parts = signatures.reshape(len(signatures), BANDS, BAND_ROWS).astype(np.uint64)
    h = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(BAND_ROWS):
        h = mix(h ^ parts[:, :, k])
    return h
