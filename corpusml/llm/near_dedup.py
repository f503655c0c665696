"""Near-duplicates by a multi-index Hamming join of MinHash signatures.

A document is the set of its distinct word shingles, its signature the minima of ``SYMBOLS`` hash
functions. Documents with equal sets are taken together first; only one of each goes on.

Multi-index: the first ``CHUNKS * WIDTH`` symbols are cut into chunks, and each chunk opens one key
for each symbol left out. Two signatures that differ in at most one symbol of some chunk share a
key: by the pigeonhole principle all pairs within distance ``2 * CHUNKS - 1`` do. At similarity 0.8
a chunk has at most one difference with probability 0.655, so a pair has no common key with
probability 0.345 ** 14, less than one in two million, and less still above.

Within a key, signatures are compared by ``BITS`` bits of every symbol. Pairs within ``DISTANCE``
differing symbols (missed at 0.8 with about the same probability) are plausible. A key hands on a
forest of its plausible pairs, never all of them; beyond ``STAR`` members it links all to its first
one, which can only make clusters coarser. Clusters are the connected components of these
forests, so every pair that can pass lies within one.

Exact links: the sets of a cluster are compared in full, in pairs of blocks of about ``BLOCK`` members,
each pair of blocks a group of its own. Pairs already connected are skipped, so what comes out is a
forest of confirmed links whose components are those of all links.

A null or empty text has an empty set, is linked with nothing and is its own component. Repeated
rows have equal sets and one component. Rows with a null id have no component and are never kept out.
An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import LOWER, mix, shingles, utf8, word_hashes
from corpusml.llm.components import connected_components
from corpusml.llm.repeats import packed
from corpusml.storage import materialize

SYMBOLS = 96
CHUNKS = 14
WIDTH = 6
BITS = 2
DISTANCE = 33
STAR = 1024
BLOCK = 256

_SALT = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_FACTOR = mix(_SALT) | np.uint64(1)


def signature(items: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over a set of 64-bit items."""
    least = np.full(SYMBOLS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(items), 2048):
        least = np.minimum(least, ((items[at : at + 2048, None] ^ _SALT) * _FACTOR).min(0))
    return least


def sketch(symbols: np.ndarray) -> np.ndarray:
    """``BITS`` bits of every symbol, packed into three 64-bit numbers."""
    bits = (mix(symbols) >> np.uint64(62)).astype(np.uint64)
    packed = bits.reshape(3, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(packed, axis=1)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that differ between sketches (last axis: the packed numbers)."""
    odd = a ^ b
    return np.bitwise_count((odd | odd >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(-1)


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """The keys of a signature: each chunk with each of its symbols left out."""
    place = np.arange(1, CHUNKS * WIDTH + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)
    coded = mix(symbols[: CHUNKS * WIDTH] ^ mix(place)).reshape(CHUNKS, WIDTH)
    return mix(coded.sum(1, dtype=np.uint64)[:, None] - coded + np.arange(WIDTH, dtype=np.uint64)).ravel().view(np.int64)


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    raw = LOWER[np.frombuffer(text or b"", np.uint8)]
    return shingles(word_hashes(raw)[0], k)


def describe(docs: DataFrame, idx: str, text: str, k: int) -> DataFrame:
    """``(doc_id, n_shingles, set1, set2, symbols)`` of every row, stored."""

    def run(parts):
        for part in parts:
            sizes, first, second, symbols = [], [], [], []
            for raw in part.column("raw"):
                items = shingle_set(raw.as_py(), k)
                sizes.append(len(items))
                # Two independent sums over the set identify it.
                first.append(int(mix(items ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                second.append(int(np.bitwise_xor.reduce(mix(items * np.uint64(0x2545F4914F6CDD1D)), initial=np.uint64(0)).view(np.int64)))
                symbols.append(signature(items).tobytes() if len(items) else b"")
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(symbols, pa.binary())],
                names=["doc_id", "n_shingles", "set1", "set2", "symbols"])

    rows = docs.select(F.col(idx).cast("long").alias("doc_id"), utf8(text).alias("raw"))
    return materialize(rows.mapInArrow(run, "doc_id long, n_shingles long, set1 long, set2 long, symbols binary"), "near-sets")


def open_keys(reps: DataFrame) -> DataFrame:
    """``(key, doc_id, s0, s1, s2)``: every key of every signature with its sketch."""

    def run(parts):
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                ids = some.column("doc_id").to_numpy(zero_copy_only=False)
                symbols = [np.frombuffer(s, np.uint64) for s in some.column("symbols").to_pylist()]
                keys = np.concatenate([index_keys(s) for s in symbols])
                sketches = np.array([sketch(s) for s in symbols]).view(np.int64)
                columns = [keys, np.repeat(ids, CHUNKS * WIDTH), *np.repeat(sketches, CHUNKS * WIDTH, axis=0).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["key", "doc_id", "s0", "s1", "s2"])

    return reps.mapInArrow(run, "key long, doc_id long, s0 long, s1 long, s2 long")


def forest(ids: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what plausible pairs connect among the members of one key."""
    waiting = np.arange(len(ids))
    links = []
    while len(waiting) > 1:
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            at = queue.pop()
            near = differing(sketches[at], sketches[waiting]) <= DISTANCE
            links += [(int(ids[at]), int(ids[i])) for i in waiting[near]]
            queue += list(waiting[near])
            waiting = waiting[~near]
    return links


def plausible_links(keys: DataFrame) -> DataFrame:
    """``(a, b)``: a forest of the plausible pairs of every key, without repeats."""

    def run(parts):
        seen: set[tuple[int, int]] = set()
        table = None  # rows of the key that is not complete yet
        hub = None  # (key, id) of a key with more than STAR rows so far

        def emit(force: bool = False):
            if seen and (force or len(seen) > 100_000):
                links = np.array(list(seen), np.int64)
                seen.clear()
                return pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"])
            return None

        def link(pairs) -> None:
            seen.update((a, b) if a > b else (b, a) for a, b in pairs if a != b)

        def close(rows: np.ndarray) -> None:
            """Handle the complete keys of rows sorted by key."""
            cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(rows))
            sizes = ends - starts
            twos = starts[sizes == 2]
            if len(twos):
                near = differing(rows[twos, 2:].view(np.uint64), rows[twos + 1, 2:].view(np.uint64)) <= DISTANCE
                link(zip(rows[twos[near], 1].tolist(), rows[twos[near] + 1, 1].tolist()))
            for s, e in zip(starts[sizes > 2], ends[sizes > 2]):
                ids = rows[s:e, 1]
                if e - s > STAR:
                    link((int(ids[0]), int(i)) for i in ids[1:])
                else:
                    link(forest(ids, np.ascontiguousarray(rows[s:e, 2:]).view(np.uint64)))

        for part in parts:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], axis=1)
            if hub is not None:
                same = rows[:, 0] == hub[0]
                link((hub[1], int(i)) for i in rows[same, 1])
                rows = rows[~same]
                if not len(rows):
                    continue
                hub = None
            if table is not None:
                rows = np.concatenate([table, rows])
            if not len(rows):
                continue
            last = np.searchsorted(rows[:, 0], rows[-1, 0])
            if last:
                close(rows[:last])
            table = rows[last:].copy()
            if len(table) > 4 * STAR:
                # Too many for one key to hold on to: the rest is linked to its first as it passes.
                hub = int(table[0, 0]), int(table[0, 1])
                link((hub[1], int(i)) for i in table[1:, 1])
                table = None
            if (batch := emit()) is not None:
                yield batch
        if table is not None and len(table):
            close(table)
        if (batch := emit(True)) is not None:
            yield batch

    near = keys.repartition("key").sortWithinPartitions("key")
    return near.mapInArrow(run, "a long, b long").distinct()


def passes(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 times the common part is at least ``percent`` times the union."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    merged = np.concatenate([a, b])
    merged.sort(kind="stable")
    common = int((merged[1:] == merged[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirmed_links(clusters: DataFrame, docs: DataFrame, idx: str, text: str, k: int, percent: int) -> DataFrame:
    """``(a, b)``: a forest of the links of every cluster, each confirmed on the full sets."""
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK)
    placed = clusters.join(sizes, "component").select(F.col("node").alias("_node"), "component", blocks.alias("blocks"))
    # Texts move compressed, and by a merge join whatever the number of members: alike at every size.
    members = packed(docs.filter(F.col(idx).isNotNull()), idx, text).join(placed.hint("merge"), F.col("doc_id") == F.col("_node"))
    members = members.select("component", "blocks", "doc_id", "body")

    def sets(parts):
        expand = zstandard.ZstdDecompressor()
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                items = [shingle_set(expand.decompress(body.as_py()), k) for body in some.column("body")]
                sketches = [sketch(signature(i)).tobytes() for i in items]
                yield pa.RecordBatch.from_arrays(
                    [some.column("component"), some.column("blocks"), some.column("doc_id"), pa.array(sketches, pa.binary()), pa.array([i.tobytes() for i in items], pa.binary())],
                    names=["component", "blocks", "doc_id", "sketch", "items"])

    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    filled = members.mapInArrow(sets, "component long, blocks long, doc_id long, sketch binary, items binary").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = filled.withColumn("other", other).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "sketch", "items")

    def run(parts):
        group, rows = None, []
        for part in parts:
            for row in zip(*(part.column(c).to_pylist() for c in range(7))):
                if row[:3] != group:
                    if len(rows) > 1:
                        yield from _links(rows, group[1] == group[2], percent)
                    group, rows = row[:3], []
                # A repeated id meets itself here; one of them is enough.
                if not rows or rows[-1][1] != row[4]:
                    rows.append(row[3:])
        if len(rows) > 1:
            yield from _links(rows, group[1] == group[2], percent)

    apart = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "doc_id")
    return apart.mapInArrow(run, "a long, b long")


def _links(rows: list[tuple], within: bool, percent: int):
    """Forest of confirmed links among the members of a pair of blocks (or of one block)."""
    blocks = np.array([r[0] for r in rows])
    ids = [r[1] for r in rows]
    sketches = np.array([np.frombuffer(r[2], np.uint64) for r in rows])
    items = [np.frombuffer(r[3], np.uint64) for r in rows]
    sizes = np.array([len(i) for i in items])
    labels = np.arange(len(rows))
    links = []
    for x in range(len(rows)):
        later = np.arange(x + 1, len(rows))
        close = (differing(sketches[x], sketches[later]) <= DISTANCE) & (np.minimum(sizes[x], sizes[later]) * 100 >= percent * np.maximum(sizes[x], sizes[later]))
        if not within:
            close &= blocks[later] != blocks[x]
        for y in later[close]:
            if labels[y] != labels[x] and passes(items[x], items[y], percent):
                links.append((ids[x], ids[y]))
                labels[labels == labels[y]] = labels[x]
    if links:
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, idx: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row."""
    sets = describe(docs, idx, text, k)
    filled = sets.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    first = filled.groupBy("set1", "set2", "n_shingles").agg(F.min("doc_id").alias("first"))
    first = materialize(first, "near-firsts")
    reps = filled.join(first.select(F.col("first").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "symbols")
    clusters = connected_components(plausible_links(open_keys(reps)))
    links = confirmed_links(clusters, docs, idx, text, k, percent)
    linked = connected_components(links).select(F.col("node").alias("first"), "component")
    classes = first.join(linked, "first", "left").select("set1", "set2", "n_shingles", F.coalesce("component", "first").alias("_component"))
    whole = sets.drop("symbols").join(classes, ["set1", "set2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    named = whole.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


OP_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
placed AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 3], ' ')) AS s FROM placed),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
components AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN components ON node = doc_id LEFT JOIN sizes USING (doc_id)"""
