"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``WINDOW`` bytes that also starts earlier in the corpus goes (smaller
document id, or the same document further left). :mod:`corpusml.llm.repeats` files all windows by a run
they share and settles whole repeats; what is left are contexts that agree in part. They are
concatenated in blocks, and a suffix array of each block brings equal windows next to each other.

The array is built in two stages. Suffixes that are smaller than their successor are sorted directly;
``WINDOW`` bytes are enough, because longer agreement does not matter. The others are induced: going
through the buckets of first bytes in ascending order, the predecessor of every suffix, if it is larger
than it, takes the next free place at the front of its own bucket. Common prefixes of neighbours
then separate the classes of equal windows, and all but the earliest of a class are removed.

A null text is empty. Texts shorter than ``WINDOW`` bytes stay whole. Rows that repeat a document id count as
the same document, so they do not remove each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusml.llm import repeats
from corpusml.llm.common import as_bytes, byte_sums, covered, spread_ranges

WINDOW = 100
RUN = 24


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that starts a place later; the last one is not."""
    smaller = np.zeros(len(text), bool)
    if len(text) < 2:
        return smaller
    differs = np.flatnonzero(text[1:] != text[:-1])
    if len(differs):
        # Within a row of equal bytes the first difference to the right decides.
        at = np.searchsorted(differs, np.arange(len(text)))
        inside = at < len(differs)
        where = differs[np.minimum(at, len(differs) - 1)]
        smaller[inside] = (text[where] < text[where + 1])[inside]
    return smaller


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes of a byte text in the order of their first ``depth`` bytes.

    Bytes must not be 0 but for separators; suffixes that agree in ``depth`` bytes are neighbours.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    smaller = smaller_than_next(text)
    direct = np.flatnonzero(smaller)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    heads = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(heads).view(f"S{depth}").ravel(), kind="stable")]
    by_byte = np.searchsorted(text[direct], np.arange(257))
    coming: list[list[np.ndarray]] = [[] for _ in range(256)]
    # The last suffix has no successor to induce it.
    coming[text[-1]].append(np.array([n - 1]))
    done = []

    def place(found: np.ndarray, bucket: int) -> np.ndarray:
        """Pass on the larger predecessors; those of the same bucket come back."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = text[before]
        later = first > bucket
        if later.any():
            there, at = first[later], before[later]
            order = np.argsort(there, kind="stable")
            there, at = there[order], at[order]
            cuts = np.flatnonzero(np.diff(there)) + 1
            for c, group in zip(there[np.append(0, cuts)], np.split(at, cuts)):
                coming[c].append(group)
        return before[first == bucket]

    for bucket in range(256):
        waiting = coming[bucket]
        while waiting:
            found = np.concatenate(waiting)
            done.append(found)
            again = place(found, bucket)
            waiting = [again] if len(again) else []
        own = direct[by_byte[bucket] : by_byte[bucket + 1]]
        if len(own):
            done.append(own)
            place(own, bucket)
    return np.concatenate(done)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in the order, at most ``depth``."""
    lengths = np.zeros(len(order), np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(depth, np.uint8)]), depth)
    for at in range(1, len(order), 20_000):
        differs = windows[order[at : at + 20_000]] != windows[order[at - 1 : min(at + 20_000, len(order)) - 1]]
        lengths[at : at + 20_000] = np.where(differs.any(1), differs.argmax(1), depth)
    return lengths


def settle(rows: list[tuple], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Windows of a block of open stretches that also start in an earlier one."""
    # Separators are 0, so text bytes move up by one; 255 does not occur in UTF-8.
    text = np.frombuffer(b"\0".join([r[4].translate(_UP) for r in rows]) + b"\0", np.uint8)
    sizes = np.array([len(r[4]) for r in rows])
    offsets = np.cumsum(sizes + 1) - sizes - 1
    windows = np.array([r[3] for r in rows])
    places = spread_ranges(offsets, windows)
    filed = np.zeros(len(text), bool)
    filed[places] = True
    order = suffix_array(text, window)
    order = order[filed[order]]
    starts = np.flatnonzero(common_prefixes(text, order, window) < window)
    # Rows are in the order of documents, so the least place of a class is its first occurrence.
    least = np.minimum.reduceat(order, starts)
    again = order != np.repeat(least, np.diff(np.append(starts, len(order))))
    found = order[again]
    row = np.searchsorted(offsets, found, "right") - 1
    ids, firsts = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    return repeats.runs_of(ids[row], firsts[row] + found - offsets[row])


_UP = bytes(min(c + 1, 255) for c in range(256))


def _sums(raw: bytes) -> np.ndarray:
    return byte_sums(as_bytes(raw))


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = RUN, idx: str = "doc_id", text: str = "text", wide: int = repeats.WIDE) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` of every document."""

    def slices(raw, firsts, windows):
        return [raw[f : f + n - 1 + window] if f + n - 1 + window <= len(raw) else None for f, n in zip(firsts.tolist(), windows.tolist())]

    def finish(raw, firsts, windows):
        gone = covered(len(raw), firsts, firsts + windows - 1 + window)
        kept = as_bytes(raw)[~gone].tobytes()
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        return len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept

    removed = repeats.removed_windows(docs, _sums, k, window, slices, lambda rows: settle(rows, window), idx, text, wide=wide)
    arrow = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    return repeats.apply_removed(docs, removed, finish, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", arrow, idx, text)


OP_SQL = f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, greatest(octet_length(encode(h)) // 2 - {WINDOW} + 1, 0))) AS s FROM docs),
filed AS (SELECT doc_id, s, md5(substr(h, (2 * s + 1)::BIGINT, {2 * WINDOW})) AS m FROM starts),
later AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) AS n FROM filed) WHERE n > 1),
edges AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM later),
islands AS (SELECT doc_id, s, sum(CASE WHEN gap <= {WINDOW} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM edges),
spans AS (SELECT doc_id, island, min(s) AS a, max(s) + {WINDOW} AS b FROM islands GROUP BY doc_id, island),
gaps AS (SELECT doc_id, lag(b, 1, 0) OVER w AS a, a AS b, FALSE AS is_last FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
         UNION ALL SELECT doc_id, max(b), NULL, TRUE FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(CASE WHEN is_last THEN substr(h, (2 * a + 1)::BIGINT) ELSE substr(h, (2 * a + 1)::BIGINT, (2 * (b - a))::BIGINT) END, '' ORDER BY a, is_last) AS rest
         FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
totals AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT docs.doc_id, (octet_length(encode(h)) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(from_hex(coalesce(rest, h))) AS kept_sha256
FROM docs LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)"""
