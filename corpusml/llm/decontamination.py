"""Benchmark decontamination by greedy string tiling.

Texts become lower-case tokens: runs of letters and digits in the sense of Unicode; invisible format characters
(soft hyphens, zero-width blanks, byte order marks) are left out, everything else separates. A match has ``MIN_MATCH`` tokens
or more; an item with fewer tokens matches only as a whole, its tokens in a row.

1. ``item_runs``: one row per distinct run of ``MIN_MATCH`` tokens of every distinct item, with its places.
2. ``shared_runs``: running Karp-Rabin hashes of the documents against a bit table of the items' hashes, which has
   ``SIEVE`` bits whatever the size of the benchmark. Runs that pass become rows under a 128-bit digest of their
   words; equal texts are taken once.
3. ``leading_runs``: of the runs of an item the most frequent ones are set aside as long as they cover less than
   ``COVERAGE`` of it together. A contaminated document has at least one of the others, so only these look for
   pairs, and a phrase that many items share brings no pairs together. Nothing is lost by it.
4. Pairs of document and item fetch the places of all runs they share, by joins.
5. ``tile``: the longest match that overlaps no tile is marked first (ties: first in the document, then in the
   item) until none is left, so a passage with its sentences moved around is found like a straight one. Matches
   come from running hashes of growing length, not from pairs of places, so repeats cost no product.

A document is contaminated by an item if the tiles cover at least ``COVERAGE`` of the item's tokens. A pair of document and
item is a group of its own; no text travels, and nothing of the benchmark passes the driver but the bit table.

Null and empty texts match nothing. Repeated documents give repeated rows, repeated items one row each. A null id of a
document or item stays null. Empty tables give no rows. Extra columns are not read (and kept by ``clean``).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import LOWER, byte_sums, mix, prefix_sums, run_hashes, slices, stretch_hashes, utf8
from corpusml.storage import discard, materialize

MIN_MATCH = 5
COVERAGE = 0.5
SIEVE = 1 << 26

_TOKEN = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_APART = re.compile(r"[^\w\x00-\x7f]+")
_UNSEEN = re.compile("[\xad\u200b-\u200f\u2060\ufeff]+")
_BLOCK = 1 << 16

Tokens = tuple[np.ndarray, np.ndarray, np.ndarray, bytes]


def tokens(text: bytes) -> Tokens:
    """``(hashes, starts, ends, lower-case bytes)`` of the tokens of a text."""
    if not text.isascii():
        seen = _UNSEEN.sub("", unicodedata.normalize("NFC", text.decode("utf-8", "replace")).lower())
        text = _APART.sub(" ", seen).encode()
    raw = LOWER[np.frombuffer(text, np.uint8)]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _TOKEN[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    return stretch_hashes(byte_sums(raw), starts, ends), starts, ends, raw.tobytes()


def runs_of(found: Tokens, k: int, passes: Callable | None = None) -> tuple[dict[bytes, list[int]], np.ndarray]:
    """Places of every distinct run of ``k`` tokens by the digest of its words, and the hashes of the runs.

    With ``passes``, only of runs whose hash it lets pass.
    """
    hashes, starts, ends, body = found
    runs = run_hashes(prefix_sums(hashes), k)
    at = np.arange(len(runs)) if passes is None else np.flatnonzero(passes(runs))
    places: dict[bytes, list[int]] = {}
    if len(at):
        used = np.unique((at[:, None] + np.arange(k)).ravel())
        words = {i: body[s:e] for i, s, e in zip(used.tolist(), starts[used].tolist(), ends[used].tolist())}
        for i in at.tolist():
            digest = hashlib.blake2b(b" ".join([words[i + d] for d in range(k)]), digest_size=16).digest()
            places.setdefault(digest, []).append(i)
    return places, runs


def _key(raw: Column) -> Column:
    return F.unhex(F.md5(raw))


def item_runs(benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``(item_key, tokens, least, run, hash, places)`` of the distinct items, stored."""
    schema = pa.schema([("item_key", pa.binary()), ("tokens", pa.int64()), ("least", pa.int32()), ("run", pa.binary()),
                        ("hash", pa.int64()), ("places", pa.list_(pa.int32()))])

    def run(parts):
        for part in slices(parts):
            rows = []
            for key, raw in zip(part.column("item_key").to_pylist(), part.column("raw")):
                found = tokens(raw.as_py())
                n = len(found[0])
                least = min(n, MIN_MATCH)
                if least:
                    places, runs = runs_of(found, least)
                    hashes = runs.view(np.int64)
                    rows += [(key, n, least, digest, int(hashes[own[0]]), own) for digest, own in places.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    items = benchmark.select(utf8(text).alias("raw")).select(_key(F.col("raw")).alias("item_key"), "raw").dropDuplicates(["item_key"])
    return materialize(items.mapInArrow(run, "item_key binary, tokens long, least int, run binary, hash long, places array<int>"), "item-runs")


def sieve(items: DataFrame) -> np.ndarray:
    """``SIEVE`` bits, packed: which hashes the runs of the items have, by their leading bits.

    Built in blocks by the executors, so the driver gets at most ``SIEVE / 8`` bytes.
    """
    bits = SIEVE.bit_length() - 1

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(_BLOCK, bool)
        own[rows["place"].to_numpy()] = True
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "packed": [np.packbits(own, bitorder="little").tobytes()]})

    place = F.shiftrightunsigned("hash", 64 - bits)
    placed = items.select(F.floor(place / _BLOCK).alias("block"), (place % _BLOCK).alias("place")).distinct()
    table = np.zeros(SIEVE // 8, np.uint8)
    for row in placed.groupBy("block").applyInPandas(pack, "block long, packed binary").collect():
        start = row["block"] * _BLOCK // 8
        table[start : start + _BLOCK // 8] = np.frombuffer(row["packed"], np.uint8)
    return table


def shared_runs(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_key, run, places)`` of the distinct texts, stored: runs that an item may have too."""
    lengths = sorted(r["least"] for r in items.select("least").distinct().collect())  # MIN_MATCH rows at most
    shared = docs.sparkSession.sparkContext.broadcast((sieve(items), lengths))
    schema = pa.schema([("doc_key", pa.binary()), ("run", pa.binary()), ("places", pa.list_(pa.int32()))])
    shift = np.uint64(64 - (SIEVE.bit_length() - 1))

    def run(parts):
        table, widths = shared.value

        def passes(runs):
            place = runs >> shift
            return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1

        for part in slices(parts):
            rows = []
            for key, raw in zip(part.column("doc_key"), part.column("raw")):
                found = tokens(raw.as_py())
                for k in widths:
                    rows += [(key.as_py(), digest, own) for digest, own in runs_of(found, k, passes)[0].items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    texts = docs.select(utf8(text).alias("raw")).select(_key(F.col("raw")).alias("doc_key"), "raw")
    hits = texts.mapInArrow(run, "doc_key binary, run binary, places array<int>")
    # A semi join drops what passed the bit table by chance.
    known = hits.join(items.select("run").distinct(), "run", "left_semi")
    stored = materialize(known.dropDuplicates(["doc_key", "run"]), "shared-runs")
    shared.destroy()
    return stored


def leading_runs(items: DataFrame, hits: DataFrame) -> DataFrame:
    """``(item_key, tokens, least, run, places, leads)`` of the items that can be covered at all, stored.

    The runs that do not lead cover less than ``COVERAGE`` of the item together.
    """
    often = hits.groupBy("run").agg(F.count("*").alias("n"))
    known = items.join(often, "run").groupBy("item_key", "tokens", "least").agg(F.collect_list(F.struct("n", "run", "places")).alias("runs"))
    schema = pa.schema([("item_key", pa.binary()), ("tokens", pa.int64()), ("least", pa.int32()), ("run", pa.binary()),
                        ("places", pa.list_(pa.int32())), ("leads", pa.bool_())])

    def run(parts):
        for part in slices(parts):
            rows = []
            for key, n, least, runs in zip(*(part.column(c).to_pylist() for c in ("item_key", "tokens", "least", "runs"))):
                covered: set[int] = set()
                own = []
                for r in sorted(runs, key=lambda r: (-r["n"], r["run"])):
                    covered.update(i + d for i in r["places"] for d in range(least))
                    own.append((key, n, least, r["run"], r["places"], len(covered) >= COVERAGE * n))
                if len(covered) >= COVERAGE * n:
                    rows += own
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = known.mapInArrow(run, "item_key binary, tokens long, least int, run binary, places array<int>, leads boolean")
    return materialize(found, "leading-runs")


class _Side:
    """The places of one text that share runs with the other, as a row of codes with breaks between."""

    def __init__(self, places: list[list[int]], least: int, breaks: int) -> None:
        sizes = [len(p) for p in places]
        flat = np.concatenate([np.asarray(p, np.int64) for p in places])
        order = np.argsort(flat, kind="stable")
        self.places, self.least = flat[order], least
        gaps = np.append(0, np.cumsum(np.diff(self.places) != 1))
        self.at = np.arange(len(flat)) + gaps
        # Breaks are all different, so no match runs over one.
        self.codes = np.arange(breaks, breaks + self.at[-1] + 1).astype(np.uint64)
        self.codes[self.at] = np.repeat(np.arange(len(places)), sizes)[order].astype(np.uint64)
        self.place_of = np.full(len(self.codes), -1)
        self.place_of[self.at] = self.places
        self.next = breaks + len(self.codes)

    def hashes(self, m: int) -> np.ndarray:
        return run_hashes(prefix_sums(mix(self.codes + np.uint64(1))), m)

    def mark(self, place: int, length: int) -> None:
        """Break up all runs that touch the tokens of a tile."""
        lo, hi = np.searchsorted(self.places, [place - self.least + 1, place + length])
        self.codes[self.at[lo:hi]] = np.arange(self.next, self.next + hi - lo).astype(np.uint64)
        self.next += hi - lo


def tile(doc: list[list[int]], item: list[list[int]], least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(document place, item place, tokens)``.

    ``doc[r]`` and ``item[r]`` are the places of the shared run ``r`` of ``least`` tokens.
    """
    if not doc:
        return []
    left, right = _Side(doc, least, 1 << 40), _Side(item, least, 1 << 50)
    tiles, longest = [], min(len(left.codes), len(right.codes))
    while True:
        # The longest common row of runs: lengths double, then close in; every row has shorter ones in it.
        def common(m: int) -> bool:
            return m <= longest and bool(np.isin(right.hashes(m), left.hashes(m)).any())

        low, high = 0, 1
        while common(high):
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if common(middle) else (low, middle)
        if not low:
            return tiles
        found = _level(left, right, low, least)
        for i, j, length in found:
            left.mark(i, length)
            right.mark(j, length)
        tiles += found
        # All rows of this length are used up or overlap a tile.
        longest = low - 1
        if not longest:
            return tiles


def _level(left: _Side, right: _Side, m: int, least: int) -> list[tuple[int, int, int]]:
    """Tiles of ``m`` runs, first to last in the document."""
    length = m + least - 1
    ours, theirs = left.hashes(m), right.hashes(m)
    waiting: dict[int, list[int]] = {}
    for j in np.flatnonzero(np.isin(theirs, ours))[::-1].tolist():
        waiting.setdefault(int(theirs[j]), []).append(j)
    used = np.zeros(int(right.places[-1]) + least + 1, bool)
    tiles, free_from = [], -1
    for i in np.flatnonzero(np.isin(ours, theirs)).tolist():
        if not waiting:
            break
        place = int(left.place_of[i])
        choice = waiting.get(int(ours[i]))
        if choice is None or place < free_from:
            continue
        # Places that overlap a tile never become free again.
        while choice and used[right.place_of[choice[-1]] : right.place_of[choice[-1]] + length].any():
            choice.pop()
        if not choice:
            del waiting[int(ours[i])]
        elif np.array_equal(left.codes[i : i + m], right.codes[choice[-1] : choice[-1] + m]):
            other = int(right.place_of[choice.pop()])
            used[other : other + length] = True
            free_from = place + length
            tiles.append((place, other, length))
    return tiles


def covered_pairs(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_key, item_key, coverage, tiles, tokens)`` of distinct texts and items, stored."""
    items = item_runs(benchmark)
    hits = shared_runs(docs, items, text)
    leading = leading_runs(items, hits)
    pairs = leading.filter("leads").select("run", "item_key").join(hits.select("run", "doc_key"), "run").select("doc_key", "item_key").distinct()
    wanted = pairs.join(leading.drop("leads").withColumnRenamed("places", "item_places"), "item_key")
    seeds = wanted.join(hits.withColumnRenamed("places", "doc_places"), ["doc_key", "run"])
    schema = pa.schema([("doc_key", pa.binary()), ("item_key", pa.binary()), ("coverage", pa.float64()), ("tiles", pa.int64()), ("tokens", pa.int64())])

    def run(parts):
        pair, ours, theirs = None, [], []

        def close():
            key, item, n, least = pair
            tiles = tile(ours, theirs, least)
            marked = sum(length for _, _, length in tiles)
            return [(key, item, marked / n, len(tiles), marked)] if marked >= COVERAGE * n else []

        for part in slices(parts):
            done = []
            for *own, mine, other in zip(*(part.column(c).to_pylist() for c in range(6))):
                if own != pair:
                    done += close() if pair else []
                    pair, ours, theirs = own, [], []
                ours.append(mine)
                theirs.append(other)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if pair and (done := close()):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    near = seeds.repartition("doc_key", "item_key").sortWithinPartitions("doc_key", "item_key", "run")
    near = near.select("doc_key", "item_key", "tokens", "least", "doc_places", "item_places")
    found = materialize(near.mapInArrow(run, "doc_key binary, item_key binary, coverage double, tiles long, tokens long"), "covered-pairs")
    for table in (items, hits, leading):
        discard(table)
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, idx: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, item_id, coverage, tiles, tokens)`` of every contaminated document and item."""
    found = covered_pairs(docs, benchmark, text)
    rows = docs.select(F.col(idx).cast("long").alias("doc_id"), _key(utf8(text)).alias("doc_key"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _key(utf8("text")).alias("item_key"))
    return rows.join(found, "doc_key").join(items, "item_key").select("doc_id", "item_id", "coverage", "tiles", "tokens")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no item contaminates, all columns kept."""
    found = covered_pairs(docs, benchmark, text).select(F.col("doc_key").alias("__found")).distinct()
    return docs.join(found, _key(utf8(text)) == F.col("__found"), "left_anti")
