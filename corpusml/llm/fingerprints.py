"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Every paragraph (line) is hashed into a wide vector of ``LANES`` numbers of two halves, and a document is
the sum of the vectors of its paragraphs, lane by lane. The order of paragraphs does not matter; inserting or deleting a paragraph adds or subtracts its vector, without the rest of the text.

The upper half of a lane, modulo 2 ** 16, adds cryptographic digests of the paragraphs and serves
equality. The lower one, modulo 2 ** 32, which no text is long enough to wrap, adds, for every run of
three words of the paragraph, plus or minus one by a bit of the run's hash, which makes likeness measurable: the
squared difference of two sums estimates how many runs they do not share. Likeness is one minus that
over the sum of both squares, cut to 0..1, and 1 for equal fingerprints.

The query pairs each document with the next one in descending id order. Ids are range-partitioned and
sorted, so neighbours meet in one task and the texts move once, compressed; the first and last document of
each partition are stored with their texts and paired afterwards (two rows per partition).

A null text is empty, and an empty text is one empty paragraph; ties of the id are in a fixed order of their compressed texts;
a null id comes last; a single document is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusml.llm.common import byte_sums, mix, prefix_sums, run_hashes, stretch_hashes, word_spans
from corpusml.llm.repeats import NO_ID, packed
from corpusml.storage import scratch_path

LANES = 64
RUN = 3
# A lane is a 64-bit number: the upper half in its highest 16 bits, the lower one in its lowest 32.
_SHIFT = 48
_UPPER, _LOWER = 0xFFFF << _SHIFT, 0xFFFFFFFF


def _signs(hashes: np.ndarray) -> np.ndarray:
    """Sum over the hashes of one sign per lane, modulo 2 ** 32."""
    bits = np.unpackbits(mix(hashes).view(np.uint8)).reshape(-1, LANES)
    return (2 * bits.sum(0, dtype=np.int64) - len(hashes)).astype(np.uint32)


def fingerprint(text: bytes) -> np.ndarray:
    """Vector of a text: the sum over its paragraphs."""
    paragraphs = text.split(b"\n")
    digests = b"".join([hashlib.shake_128(p).digest(2 * LANES) for p in paragraphs])
    upper = np.frombuffer(digests, "<u2").reshape(-1, LANES).sum(0, dtype=np.uint64).astype(np.uint16)
    raw = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(raw)
    lower = np.zeros(LANES, np.uint32)
    if len(starts):
        words = stretch_hashes(byte_sums(raw), starts, ends)
        where = np.searchsorted(np.flatnonzero(raw == 10), starts)
        sums = prefix_sums(words)
        runs = run_hashes(sums, RUN)[where[RUN - 1 :] == where[: len(where) - RUN + 1]] if len(words) >= RUN else np.zeros(0, np.uint64)
        # A paragraph with fewer words is one run.
        heads = np.flatnonzero(np.diff(where, prepend=-1))
        tails = np.append(heads[1:], len(words))
        short = tails - heads < RUN
        lower = _signs(np.concatenate([runs, stretch_hashes(sums, heads[short], tails[short])]))
    return upper.astype(np.uint64) << np.uint64(_SHIFT) | lower


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of the paragraphs of both texts together."""
    return (a & _UPPER) + (b & _UPPER) | (a + b) & _LOWER


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of the first text without the paragraphs of the second."""
    return (a & _UPPER) - (b & _UPPER) | (a - b) & _LOWER


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if np.array_equal(a, b):
        return 1.0
    low = [(x & _LOWER).astype(np.uint32).view(np.int32).astype(np.float64) for x in (a, b)]
    both = float(low[0] @ low[0] + low[1] @ low[1])
    apart = (a - b & _LOWER).astype(np.uint32).view(np.int32).astype(np.float64)
    return 0.0 if both == 0 else min(1.0, max(0.0, 1 - float(apart @ apart) / both))


def to_text(vector: np.ndarray) -> str:
    return ((vector >> np.uint64(_SHIFT)).astype("<u2").tobytes() + (vector & _LOWER).astype("<u4").tobytes()).hex()


def edit(text: str, following: str) -> tuple[str, int]:
    """The last third replaced by as many characters of the next text, and where that begins."""
    at = len(text) - len(text) // 3
    return text[:at] + following[: len(text) // 3], at


def compare(text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> tuple[int, str, str, str, float, float]:
    """``(n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``."""
    edited, at = edit(text, following)
    # Paragraphs that end before the edit stay; only the others are taken out and put in anew.
    kept = text.rfind("\n", 0, at) + 1
    if kept:
        changed = add(subtract(own, fingerprint(text[kept:].encode())), fingerprint(edited[kept:].encode()))
    else:
        changed = fingerprint(edited.encode())
    return (len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(own), to_text(changed), likeness(own, changed), likeness(own, next_own))


_RESULT = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_RESULT_SQL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, idx: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its fingerprint, its edited text's, and their likeness; see the module."""
    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), *_RESULT, ("part", pa.string()), ("place", pa.int32()), ("text", pa.string())])

    def run(parts):
        # place: 0 complete, 1 first of a partition (again, with its text), 2 last (its next is elsewhere)
        held, name = None, None
        expand = zstandard.ZstdDecompressor()
        for part in parts:
            rows = []
            for doc_id, squeezed in zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist()):
                doc_id = None if doc_id == NO_ID else doc_id
                body = expand.decompress(squeezed).decode()
                own = fingerprint(body.encode())
                if held is None:
                    name = hashlib.sha256(f"{doc_id}".encode()).hexdigest()
                    rows.append((doc_id, *[None] * 6, name, 1, body))
                else:
                    rows.append((held[0], *compare(held[1], held[2], body, own), None, 0, None))
                held = doc_id, body, own
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((held[0], *[None] * 6, name, 2, held[1]), schema)], schema=schema)

    order = F.col("doc_id").desc()
    ranged = packed(docs, idx, text).repartitionByRange(order).sortWithinPartitions(order, "body")
    path = scratch_path(spark, "fingerprints")
    walked = ranged.mapInArrow(run, f"doc_id long, {_RESULT_SQL}, part string, place int, text string")
    walked.write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    done = stored.filter("place = 0").select("doc_id", *[n for n, _ in _RESULT])
    return done.union(_pair_edges(stored))


def _pair_edges(stored: DataFrame) -> DataFrame:
    """Results of the last document of every partition: its next is the first of the following one."""
    firsts = stored.filter("place = 1").select("part", "doc_id", "text")
    ordered = Window.orderBy(F.col("doc_id").desc_nulls_last())
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One narrow row per partition; after the last one comes the first one again.
    following = firsts.select("part", F.coalesce(F.lead("part").over(ordered), F.first("part").over(whole)).alias("_next"))
    heads = firsts.select(F.col("part").alias("_next"), F.col("text").alias("next_text"))
    pairs = stored.filter("place = 2").select("part", "doc_id", "text").join(following, "part").join(heads, "_next")
    schema = pa.schema([("doc_id", pa.int64()), *_RESULT])

    def run(parts):
        for part in parts:
            rows = [
                (doc_id, *compare(body, fingerprint(body.encode()), after, fingerprint(after.encode())))
                for doc_id, body, after in zip(*(part.column(c).to_pylist() for c in range(3)))
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return pairs.select("doc_id", "text", "next_text").mapInArrow(run, f"doc_id long, {_RESULT_SQL}")
