"""Shared pieces of the training-text operators: row selection and vectorized hashing.

Hashes here are computed by numpy inside Spark tasks. A byte or word string is hashed by a
polynomial over 64-bit integers, so the hash of any stretch comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that separate words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C13  # 3 modulo 4: powers differ in low bits
_WRAP = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes A-Z to a-z, the others unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _series(which: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the base ("up") or of its inverse ("down")."""
    known = _powers[which]
    while len(known) < n:
        step = pow(_BASE if which == "up" else _INVERSE, len(known), 1 << 64)
        known = np.concatenate([known, known * np.uint64(step)])
    if len(known) <= 1 << 22:  # a single huge text should not leave its table behind
        _powers[which] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & _WRAP], np.uint64))[0])


def _byte_codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(mix_int(seed)))


_CODES = _byte_codes(0)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums that :func:`stretch_hashes` takes differences of."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _series("up", len(values)), out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every stretch ``starts[i]:ends[i]`` of the hashed sequence."""
    return mix((sums[ends] - sums[starts]) * _series("down", len(sums))[starts] + (ends - starts).astype(np.uint64))


def run_hashes(sums: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive items (none when there are fewer)."""
    n = len(sums) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[k:] - sums[:n]) * _series("down", n) + np.uint64(k))


def byte_sums(raw: np.ndarray) -> np.ndarray:
    return prefix_sums(_CODES[raw])


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the starts and ends of the words of a text."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~BLANK[raw]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, starts, ends)`` of the words of a text given as bytes."""
    starts, ends = word_spans(raw)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    return stretch_hashes(byte_sums(raw), starts, ends), starts, ends


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words; of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    return np.unique(run_hashes(prefix_sums(hashes), min(k, len(hashes))))


def as_bytes(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text or b"", np.uint8)


def spread_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges ``starts[i] : starts[i] + lengths[i]``, one range after the other."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - firsts, lengths)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the ``n`` positions that lie in any of the half-open stretches."""
    depth = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(depth[:n]) > 0


def utf8(text: Column | str) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))


def slices(parts: Iterator[pa.RecordBatch], size: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, which keeps down what a task holds of long texts."""
    for part in parts:
        for at in range(0, part.num_rows, size):
            yield part.slice(at, size)
