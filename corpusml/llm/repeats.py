"""Where a window of a fixed number of items (bytes or words) occurs a second time.

Every window is filed under the run of ``k`` items in it with the least hash, the leftmost of equal
ones. That choice depends on the content alone, so equal windows are filed under equal runs at
the same place; neighbouring windows mostly share their run. A *stretch* is a maximal row of
windows with a common run; about one in ``(w + 1) / 2`` positions opens one, ``w`` being the
runs in a window.

1. ``stretches``: one narrow row per stretch with the hash of its run and of its whole content. Within a
   batch of documents, stretches that repeat an earlier one are settled at once and sent under a key of
   their own, so a passage that many documents share does not pile up under one key.
2. ``sort_out``: rows are sorted by run and content. A stretch whose content occurs earlier is removed
   whole. Runs that are left with several different contents are *open*: parts of them may be equal.
3. ``fetch``: the contents of the first stretch of each open kind.
4. An operator finds the equal windows among the open contents of each run (suffix arrays, automata).
   A run with more than ``WIDE`` different contents is not held together: its windows are hashed one by
   one and the first of each hash is found by an aggregation, which gives the same rows.
5. ``apply_removed``: all removed pieces of a document are gathered and taken out of it.

Texts move by document id twice, compressed; nothing else holds text but the open contents. Tasks
read sorted streams and keep one run, or a bounded block, at a time. Two 64-bit hashes stand for a content.

Documents are ordered by id; rows that repeat an id are the same document to the operators. A null id
sorts before all others.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import mix, run_hashes, stretch_hashes, utf8
from corpusml.storage import materialize

_PLACES = 20
_CHUNK = (1 << _PLACES) - (1 << 12)
NO_ID = -(1 << 63)
#: Different contents of one run that a task compares at once.
WIDE = 200_000


def least_in_windows(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    width, least = 1, values
    while 2 * width <= w:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    n = len(values) - w + 1
    return np.minimum(least[:n], least[w - width : w - width + n])


def file_windows(runs: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(firsts, lasts, at)``: the windows ``firsts..lasts`` of a stretch and the place of its run."""
    windows = len(runs) - w + 1
    if windows <= 0:
        return (np.zeros(0, np.int64),) * 3
    places = np.empty(windows, np.int64)
    mask = np.uint64((1 << _PLACES) - 1)
    for start in range(0, windows, _CHUNK):
        part = runs[start : start + _CHUNK + w - 1]
        # The place breaks ties to the left.
        tagged = (part & ~mask) | np.arange(len(part), dtype=np.uint64)
        places[start : start + _CHUNK] = (least_in_windows(tagged, w) & mask).astype(np.int64) + start
    cuts = np.flatnonzero(np.diff(places)) + 1
    firsts = np.append(0, cuts)
    return firsts, np.append(cuts, windows) - 1, places[firsts]


def stretch_rows(sums: np.ndarray, k: int, window: int):
    """``(run hash, content hash, first window, windows)`` of every stretch of a document."""
    runs = run_hashes(sums, k)
    firsts, lasts, at = file_windows(runs, window - k + 1)
    contents = stretch_hashes(sums, firsts, lasts + window) + (at - firsts).astype(np.uint64)
    return runs[at], mix(contents), firsts, lasts - firsts + 1


def stretches(docs: DataFrame, item_sums: Callable[[bytes], np.ndarray], k: int, window: int) -> DataFrame:
    """``(run, content, doc_id, first, windows, settled)`` of ``(doc_id, raw)`` rows."""

    def run(parts):
        for part in parts:
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            found = []
            for doc_id, raw in zip(ids.tolist(), part.column("raw")):
                sums = item_sums(raw.as_py())
                if len(sums) > window:
                    keys, contents, firsts, windows = stretch_rows(sums, k, window)
                    found.append((keys, contents, np.full(len(keys), doc_id), firsts, windows))
            if not found:
                continue
            keys, contents, owners, firsts, windows = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((firsts, owners, contents, keys))
            keys, contents, owners, firsts, windows = (c[order] for c in (keys, contents, owners, firsts, windows))
            again = np.append(False, (keys[1:] == keys[:-1]) & (contents[1:] == contents[:-1]))
            head = np.maximum.accumulate(np.where(again, 0, np.arange(len(keys))))
            # The same place once more, from a repeated row, is no second occurrence.
            settled = again & ((owners != owners[head]) | (firsts != firsts[head]))
            # Settled rows only travel on: any key will do, each its own.
            keys[settled] = mix(keys[settled] + owners[settled].astype(np.uint64) + (firsts[settled].astype(np.uint64) << np.uint64(32)))
            for at in range(0, len(keys), 200_000):
                some = slice(at, at + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[some].view(np.int64)), pa.array(contents[some].view(np.int64)), pa.array(owners[some]),
                     pa.array(firsts[some].astype(np.int32)), pa.array(windows[some].astype(np.int32)), pa.array(settled[some])],
                    names=["run", "content", "doc_id", "first", "windows", "settled"])

    return docs.mapInArrow(run, "run long, content long, doc_id long, first int, windows int, settled boolean")


def sort_out(rows: DataFrame) -> DataFrame:
    """``(run, doc_id, first, windows, open)``, stored: stretches removed whole, and first ones of open runs."""
    schema = pa.schema([("run", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int32()), ("windows", pa.int32()), ("open", pa.bool_())])

    def run(parts):
        last = None  # (run, content) of the row before, and the place where that content is first
        waiting = None  # first stretch of the current run while it has one content only
        for part in parts:
            if not part.num_rows:
                continue
            settled = part.column("settled").to_numpy(zero_copy_only=False)
            every = [part.column(c).to_numpy(zero_copy_only=False) for c in ("run", "doc_id", "first", "windows")]
            keys, contents = (part.column(c).to_numpy(zero_copy_only=False)[~settled] for c in ("run", "content"))
            own = [c[~settled] for c in every]
            given = [c[settled] for c in every]
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in given], pa.array(np.zeros(len(given[0]), bool))], schema=schema)
            if not len(keys):
                continue
            new_run = np.append(last is None or keys[0] != last[0], keys[1:] != keys[:-1])
            new_kind = new_run | np.append(last is None or contents[0] != last[1], contents[1:] != contents[:-1])
            # Group 0 goes on with the run of the batch before; its kinds are never the only ones.
            group = np.cumsum(new_run)
            heads = np.flatnonzero(new_kind)
            of_head = group[heads]
            several = (of_head == 0) | (np.bincount(of_head, minlength=2)[of_head] > 1)
            goes_on = bool((of_head == 0).any())
            if goes_on and waiting is not None:
                yield pa.RecordBatch.from_arrays([*[pa.array([v], f.type) for v, f in zip(waiting, schema)], pa.array([True])], schema=schema)
            head = np.maximum.accumulate(np.where(new_kind, np.arange(len(keys)), -1))
            owner, place = (np.where(head < 0, 0 if last is None else last[i], own[i - 1][np.maximum(head, 0)]) for i in (2, 3))
            # The same place once more, from a repeated row, is no second occurrence.
            later = ~new_kind & ((own[1] != owner) | (own[2] != place))
            picked = np.append(np.flatnonzero(later), heads[several])
            is_open = np.append(np.zeros(int(later.sum()), bool), np.ones(int(several.sum()), bool))
            yield pa.RecordBatch.from_arrays([*[pa.array(c[picked]) for c in own], pa.array(is_open)], schema=schema)
            if group[-1]:
                ending = heads[of_head == group[-1]]
                waiting = tuple(c[ending[0]] for c in own) if len(ending) == 1 else None
            elif goes_on:
                waiting = None
            last = keys[-1], contents[-1], owner[-1], place[-1]

    near = rows.repartition("run").sortWithinPartitions("run", "content", "doc_id", "first")
    walked = near.select("run", "content", "doc_id", "first", "windows", "settled").mapInArrow(
        run, "run long, doc_id long, first int, windows int, open boolean")
    return materialize(walked, "stretches")


def packed(docs: DataFrame, idx: str, text: str) -> DataFrame:
    """``(doc_id, body)``: texts as compressed UTF-8, for the shuffles by document."""

    def run(parts):
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in parts:
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([squeeze.compress(raw.as_py()) for raw in part.column("raw")], pa.binary())], names=["doc_id", "body"])

    return source(docs, idx, text).mapInArrow(run, "doc_id long, body binary")


def source(docs: DataFrame, idx: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(idx).cast("long"), F.lit(NO_ID)).alias("doc_id"), utf8(text).alias("raw"))


def fetch(docs: DataFrame, found: DataFrame, slices: Callable, idx: str, text: str) -> DataFrame:
    """``(run, doc_id, first, windows, piece)``: the contents of the open stretches.

    ``slices(raw, firsts, windows)`` cuts the pieces out of a text, None where it is too short.
    """
    wanted = found.filter("open").groupBy("doc_id").agg(F.collect_list(F.struct("run", "first", "windows")).alias("wanted"))
    # One row per document, also where the table repeats it.
    single = packed(docs, idx, text).join(wanted, "doc_id").dropDuplicates(["doc_id"])

    def run(parts):
        expand = zstandard.ZstdDecompressor()
        for part in parts:
            for doc_id, body, wants in zip(part.column("doc_id"), part.column("body"), part.column("wanted")):
                flat = wants.values
                keys, firsts, windows = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("run", "first", "windows"))
                pieces = slices(expand.decompress(body.as_py()), firsts, windows)
                # A row that repeats an id with a shorter text does not have them all.
                there = np.array([p is not None for p in pieces])
                keys, firsts, windows = keys[there], firsts[there], windows[there]
                pieces = [p for p in pieces if p is not None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(len(keys), doc_id.as_py())), pa.array(firsts), pa.array(windows), pa.array(pieces, pa.binary())],
                    names=["run", "doc_id", "first", "windows", "piece"])

    return single.select("doc_id", "body", "wanted").mapInArrow(run, "run long, doc_id long, first int, windows int, piece binary")


def by_run(pieces: DataFrame, settle: Callable[[list[tuple]], list[tuple[int, int, int]]], block_bytes: int) -> DataFrame:
    """``(doc_id, first, windows)`` removed among the open stretches.

    ``settle`` gets the rows ``(run, doc_id, first, windows, piece)`` of whole runs, sorted, in blocks of
    about ``block_bytes``, and returns the rows of windows that also start earlier.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())])

    def run(parts):
        rows, size = [], 0
        for part in parts:
            for row in zip(*(part.column(c).to_pylist() for c in range(5))):
                if size >= block_bytes and row[0] != rows[-1][0]:
                    if done := settle(rows):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows and (done := settle(rows)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    near = pieces.repartition("run").sortWithinPartitions("run", "doc_id", "first")
    return near.mapInArrow(run, "doc_id long, first int, windows int")


def window_by_window(pieces: DataFrame, item_sums: Callable[[bytes], np.ndarray], window: int) -> DataFrame:
    """The rows of :func:`by_run` for runs of any width, through hashes of single windows."""

    def run(parts):
        for part in parts:
            for doc_id, first, windows, piece in zip(*(part.column(c).to_pylist() for c in ("doc_id", "first", "windows", "piece"))):
                hashes = run_hashes(item_sums(piece), window)[:windows]
                starts = np.arange(first, first + windows, dtype=np.int32)
                again = mix(hashes ^ np.uint64(0x94D049BB133111EB))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(again.view(np.int64)), pa.array(np.full(windows, doc_id)), pa.array(starts)],
                    names=["hash", "again", "doc_id", "start"])

    rows = pieces.mapInArrow(run, "hash long, again long, doc_id long, start int")
    firsts = rows.groupBy("hash", "again").agg(F.min(F.struct("doc_id", "start")).alias("least"))
    later = rows.join(firsts, ["hash", "again"]).filter(F.struct("doc_id", "start") > F.col("least"))
    return later.select("doc_id", F.col("start").alias("first"), F.lit(1).alias("windows"))


def removed_windows(docs: DataFrame, item_sums: Callable, k: int, window: int, slices: Callable, settle: Callable,
                    idx: str, text: str, block_bytes: int = 1 << 20, wide: int = WIDE) -> DataFrame:
    """``(doc_id, first, windows)``: all windows that also start earlier, as rows of neighbours."""
    found = sort_out(stretches(source(docs, idx, text), item_sums, k, window))
    whole = found.filter("not open").select("doc_id", "first", "windows")
    broad = found.filter("open").groupBy("run").agg(F.count("*").alias("n")).filter(F.col("n") > wide).select("run")
    if broad.isEmpty():
        return whole.union(by_run(fetch(docs, found, slices, idx, text), settle, block_bytes))
    narrow = found.filter("open").join(broad, "run", "left_anti")
    spread = found.filter("open").join(broad, "run", "left_semi")
    cut = by_run(fetch(docs, narrow, slices, idx, text), settle, block_bytes)
    return whole.union(cut).union(window_by_window(fetch(docs, spread, slices, idx, text), item_sums, window))


def runs_of(doc_ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """``(doc_id, first, windows)`` rows out of single windows, neighbours together."""
    order = np.lexsort((starts, doc_ids))
    doc_ids, starts = doc_ids[order], starts[order]
    cut = np.append(True, (doc_ids[1:] != doc_ids[:-1]) | (starts[1:] != starts[:-1] + 1)) if len(starts) else np.zeros(0, bool)
    heads = np.flatnonzero(cut)
    sizes = np.diff(np.append(heads, len(starts)))
    return list(zip(doc_ids[heads].tolist(), starts[heads].tolist(), sizes.tolist()))


def apply_removed(docs: DataFrame, removed: DataFrame, finish: Callable, schema: str, arrow: pa.Schema, idx: str, text: str) -> DataFrame:
    """``finish(raw, firsts, windows)`` for every document with its removed windows."""
    gathered = removed.groupBy("doc_id").agg(F.collect_list(F.struct("first", "windows")).alias("cut"))
    rows = packed(docs, idx, text).join(gathered, "doc_id", "left").select("doc_id", "body", "cut")
    names = pa.schema([pa.field("doc_id", pa.int64()), *arrow])

    def run(parts):
        expand = zstandard.ZstdDecompressor()
        none = np.zeros(0, np.int32)
        for part in parts:
            out = []
            for doc_id, body, cut in zip(part.column("doc_id").to_pylist(), part.column("body"), part.column("cut")):
                flat = cut.values if cut.is_valid else None
                firsts, windows = (none, none) if flat is None else (flat.field(n).to_numpy(zero_copy_only=False) for n in ("first", "windows"))
                out.append((None if doc_id == NO_ID else doc_id, *finish(expand.decompress(body.as_py()), firsts, windows)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), names)], schema=names)

    return rows.mapInArrow(run, f"doc_id long, {schema}")
