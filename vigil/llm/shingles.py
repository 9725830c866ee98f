"""Word shingles of whole texts as sorted 64-bit hashes, in numpy over groups of texts."""

from __future__ import annotations

import numpy as np

from vigil.llm.common import groups_by_bytes

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0  # separators add nothing to the word before them
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))
_FAR = np.cumprod(np.full(1 << 20, 0xD6E8FEB86659FD93, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (and end).

    A-Z is lower-cased; words are runs of bytes other than space and 0x09-0x0D.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    buf = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    gap = _SPACE[buf]
    starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    place = np.arange(len(buf), dtype=np.int32)
    place -= np.repeat(np.concatenate(([0], starts)).astype(np.int32), np.diff(np.concatenate(([0], starts, [len(buf)]))))
    value = _BYTE[buf]
    value *= _POWERS[place & 4095]
    far = np.flatnonzero(place >= 4096)
    if len(far):
        value[far] *= _FAR[(place[far] >> 12) % len(_FAR)]
    return mix(np.add.reduceat(value, starts)), np.searchsorted(starts, at)


def sequence_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words."""
    n = len(words) - k + 1
    out = np.full(max(n, 0), k, np.uint64)
    for j in range(k if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_sets(ids: list, texts: list[bytes], k: int):
    """``(id, sorted distinct shingle hashes)`` of each text: runs of ``k`` words; with fewer
    words the whole sequence as one; without words none."""
    for some_ids, some in groups_by_bytes(ids, texts):
        words, at = word_hashes(some)
        runs = sequence_hashes(words, k)
        for i, a, b in zip(some_ids, at[:-1].tolist(), at[1:].tolist()):
            if b - a >= k:
                yield i, np.unique(runs[a:b - k + 1])
            elif b > a:
                yield i, sequence_hashes(words[a:b], b - a)
            else:
                yield i, np.empty(0, np.uint64)
