"""Alignment of the tokens of two tokenizers over the same texts.

Every text is encoded by both, and the byte offsets where a token ends are compared. Offsets where
tokens of both end cut the text into groups; all pairs of tokens of a group are linked.

**Diagonal run skipping.** While tokens match one to one, the two arrays of ends agree at a constant
shift of their places. Such a stretch is jumped: its length is probed with 1, 2, 4, ... places at a time
(a comparison of memory), then found by halving. Where ends disagree, the two arrays are walked until they
meet again, which settles one irregular group and gives the new shift.

**Corpus-wide counts.** A task encodes its documents in blocks of a bounded number of bytes. A block is
stored as one row: the results of its documents, its distinct id pairs with the number of documents that
have each, and for every document the places of its pairs in that list. Only a block's distinct pairs, which
are far fewer than those of its documents, are summed up over the corpus and joined back to the block, so
no row per document and pair is ever shuffled. The highest count of each id of the first tokenizer is a table
of at most its vocabulary, which is what makes it safe to broadcast.

Equal pieces of the texts of a block (a blank and what follows it up to the next one) are encoded once: neither
tokenizer joins them with their neighbours, which is checked against the vocabulary.

A text that is null, empty or not valid UTF-8, or whose tokens do not add up to a blank and the text (the second
tokenizer cannot tell U+2581 from a blank), has no tokens: zeros and an empty ``groups_sha256``. Each row is a document of its own, also if ids
repeat or are null. Texts may be of any length; a group of thousands of tokens is counted by its distinct
ids. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import slices, spread_ranges
from corpusml.storage import scratch_path

FOLDER = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text of a block; a block ends with the document that exceeds it.
BLOCK_BYTES = 4 << 20
#: Token pairs of one group that are listed one by one; beyond it, equal ids are counted first.
WIDE_GROUP = 4096
#: Places compared one by one before the probing by jumps begins.
STEPS = 8
#: Tokens that are walked at once, a text at least.
SEGMENT = 1 << 14
#: Bytes of pieces whose ids a worker remembers.
MEMORY = 8 << 20


# tokenizers -------------------------------------------------------------------------------

#: How a byte-level vocabulary cuts a text before merging (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers with the bytes of their tokens, made from the contents of their files."""

    def __init__(self, first: bytes, second: bytes) -> None:
        import sentencepiece
        import tiktoken

        letters = byte_letters()
        model = json.loads(first)
        special = {t["content"] for t in model["added_tokens"]}
        # In this vocabulary ids are in the order of the merges. Strings of special tokens are plain text.
        ranks = {bytes(letters[c] for c in entry): i for entry, i in model["model"]["vocab"].items() if entry not in special}
        self.first = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        self.first_bytes = [b""] * (1 + max(ranks.values()))
        for entry, i in ranks.items():
            self.first_bytes[i] = entry
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else b"" if self.second.is_control(i) or self.second.is_unknown(i)
            else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.lengths = [np.array([len(b) for b in table], np.int64) for table in (self.first_bytes, self.second_bytes)]
        # The first never joins what stands before a blank with it; the second only if it has such a piece.
        self.may_cut = not any(re.search(r"[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered: the place of every known piece, and the ids of all of them."""
        self.places: dict[str, int] = {}
        self.flat: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        self.counts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        self.bad: set[int] = set()
        self.remembered = 0

    def remember(self, pieces: list[str], sizes: np.ndarray) -> None:
        """Encode pieces that can be cut from their text, together; one by one where that fails."""
        found = self.encode_joined(pieces, sizes) if len(pieces) > 1 else None
        if found is not None:
            for side in (0, 1):
                self.flat[side].append(found[side])
                self.counts[side].append(np.diff(found[2 + side], prepend=0))
        else:
            for at, piece in enumerate(pieces, len(self.places)):
                one = self.encode_one(piece)
                if one is None:
                    self.bad.add(at)
                for side in (0, 1):
                    self.flat[side].append(one[side] if one else np.zeros(0, np.int64))
                    self.counts[side].append(np.array([len(self.flat[side][-1])]))
        self.places.update(zip(pieces, range(len(self.places), len(self.places) + len(pieces))))
        self.remembered += int(sizes.sum())

    def encode_one(self, piece: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a text that begins with a blank; None where their bytes are not those of the text."""
        a, b, raw = self.first.encode_ordinary(piece), self.second.encode(piece[1:], num_threads=1), piece.encode()
        if b"".join([self.first_bytes[i] for i in a]) == raw == b"".join([self.second_bytes[i] for i in b]):
            return np.array(a, np.int64), np.array(b, np.int64)
        return None

    def encode_joined(self, pieces: list[str], sizes: np.ndarray):
        """For texts that begin with a blank and can be cut there: ``(a, b, ends of a, ends of b)``, ends by piece."""
        found = self.encode_one("".join(pieces))
        if found is None:
            return None
        bounds = np.cumsum(sizes)
        ends = [np.searchsorted(np.cumsum(n[x]), bounds) + 1 for n, x in zip(self.lengths, found)]
        return *found, *ends


@functools.lru_cache(maxsize=1)
def _tokenizers(first: bytes, second: bytes) -> Tokenizers:
    return Tokenizers(first, second)


def cut_places(raw: np.ndarray) -> np.ndarray:
    """Places of blanks before which a text can be cut: after visible ASCII, or a letter of two bytes, or of
    the three-byte ranges without any white space."""
    at = np.flatnonzero(raw == 0x20)
    at = at[at >= 3]
    one, two, three = raw[at - 1], raw[at - 2], raw[at - 3]
    follows = (one >= 0x80) & (one < 0xC0)
    ascii_ = (one > 0x20) & (one < 0x7F)
    return at[ascii_ | follows & ((two >= 0xC3) & (two <= 0xDF) | (two >= 0x80) & (two < 0xC0) & (three >= 0xE4) & (three <= 0xED))]


def encode_texts(texts: list[bytes], tokenizers: Tokenizers, chunk: int = 1 << 16):
    """``(a, b, ends of a, ends of b, ok)``: the ids of all texts, each after a blank, one after the other, and where
    those of each text end. Equal pieces of the texts are encoded once."""
    raw = np.frombuffer(b"".join([b" " + t for t in texts]), np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    text_starts = np.append(0, text_ends[:-1])
    # A blank that opens a text is its start, whatever stood before.
    # A single blank at the end stays with its piece: the second tokenizer adds no blank to nothing.
    places = cut_places(raw)
    cuts = np.sort(np.concatenate([places[~np.isin(places, text_ends - 1)], text_starts])) if tokenizers.may_cut else text_starts
    cuts = cuts[np.diff(cuts, prepend=-1) > 0]
    offsets = np.append(cuts, len(raw)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_string(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    coded = pieces.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    distinct = coded.dictionary.to_pylist()
    sizes = np.diff(np.frombuffer(coded.dictionary.buffers()[1], np.int64)[: len(distinct) + 1])
    # The last piece of a text may end in anything, so it is encoded by itself, as are texts that are not cut.
    last = np.zeros(len(distinct), bool)
    last[codes[np.searchsorted(cuts, text_ends) - 1]] = True
    if tokenizers.remembered > MEMORY:
        tokenizers.forget()
    fresh = np.array([p not in tokenizers.places for p in distinct], bool)
    joined = np.flatnonzero(fresh & ~last)
    parts = np.split(joined, np.flatnonzero(np.diff(np.cumsum(sizes[joined]) // chunk)) + 1) if len(joined) else []
    for part in [*parts, *np.flatnonzero(fresh & last)[:, None]]:
        tokenizers.remember([distinct[m] for m in part.tolist()], sizes[part])
    place = np.array([tokenizers.places[p] for p in distinct], np.int64)
    owner = np.searchsorted(text_ends, cuts, side="right")
    bad = np.zeros(len(texts), bool)
    if tokenizers.bad:
        bad[owner[np.isin(place[codes], list(tokenizers.bad))]] = True
        codes, owner = codes[~bad[owner]], owner[~bad[owner]]
    place = place[codes]
    out, ends = [], []
    for side in (0, 1):
        flat, counts = (np.concatenate(x) for x in (tokenizers.flat[side], tokenizers.counts[side]))
        tokenizers.flat[side], tokenizers.counts[side] = [flat], [counts]
        starts = np.cumsum(counts) - counts
        sizes_of = counts[place]
        out.append(flat[spread_ranges(starts[place], sizes_of)])
        ends.append(np.cumsum(np.bincount(owner, weights=sizes_of, minlength=len(texts)).astype(np.int64)))
    return *out, *ends, ~bad


# alignment --------------------------------------------------------------------------------

def meeting_runs(a: np.ndarray, b: np.ndarray) -> list[int]:
    """``i, j, end, i, j, end, ...``: runs in which ``a[i + t] == b[j + t]`` while ``i + t < end``, covering all common ends.

    ``a`` and ``b`` are strictly ascending and end alike.
    """
    la, lb = a.tolist(), b.tolist()
    raw_a, raw_b = a.tobytes(), b.tobytes()
    end_a, most = len(la), min(len(la), len(lb))
    la.append(-1)  # both lists end in a place without a match
    lb.append(-2)
    out: list[int] = []
    i = j = 0
    while i < end_a:
        x, y = la[i], lb[j]
        # An irregular group: walk until both end together.
        while x != y:
            if x < y:
                i += 1
                x = la[i]
            else:
                j += 1
                y = lb[j]
        from_i, from_j = i, j
        i += 1
        j += 1
        near = i + STEPS
        # The shift holds: single steps first, then jumps of doubled width, then halved ones for the rest.
        while la[i] == lb[j]:
            i += 1
            j += 1
            if i == near:
                width, grows = STEPS, True
                while width:
                    if i + width <= end_a and raw_a[8 * i : 8 * (i + width)] == raw_b[8 * j : 8 * (j + width)]:
                        i += width
                        j += width
                    else:
                        grows = False
                    width = 2 * width if grows else width // 2
                break
        out += (from_i, from_j, i)
    return out


def groups(ends_a: np.ndarray, ends_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens up to and with each group, for both tokenizers.

    ``stop_a`` and ``stop_b`` are places up to which both have the same bytes; walks between them stay short.
    """
    runs, from_a, from_b = [], 0, 0
    for to_a, to_b in zip(stop_a.tolist(), stop_b.tolist()):
        if to_a - from_a < SEGMENT and to_a < len(ends_a):
            continue
        found = np.array(meeting_runs(ends_a[from_a:to_a], ends_b[from_b:to_b]), np.int64).reshape(-1, 3)
        runs.append(found + np.array([from_a, from_b, from_a]))
        from_a, from_b = to_a, to_b
        if to_a == len(ends_a):
            break
    i, j, end = np.concatenate(runs).T if runs else np.zeros((3, 0), np.int64)
    return spread_ranges(i, end - i) + 1, spread_ranges(j, end - i) + 1


def links(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id pairs (as one number) that are linked, how many occurrences each row stands for, and its group."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    product = size_a * size_b
    single = np.flatnonzero(product == 1)
    keys, group = [a[cut_a[single] - 1] << 32 | b[cut_b[single] - 1]], [single]
    listed = np.flatnonzero((product > 1) & (product <= WIDE_GROUP))
    # For every token of a in these groups: all tokens of b of its group.
    places = spread_ranges(cut_a[listed] - size_a[listed], size_a[listed])
    each = np.repeat(size_b[listed], size_a[listed])
    keys.append(np.repeat(a[places], each) << 32 | b[spread_ranges(np.repeat((cut_b - size_b)[listed], size_a[listed]), each)])
    group.append(np.repeat(listed, product[listed]))
    times = [np.ones(len(k), np.int64) for k in keys]
    for g in np.flatnonzero(product > WIDE_GROUP).tolist():
        one, of_one = np.unique(a[cut_a[g] - size_a[g] : cut_a[g]], return_counts=True)
        two, of_two = np.unique(b[cut_b[g] - size_b[g] : cut_b[g]], return_counts=True)
        keys.append((one[:, None] << 32 | two[None, :]).ravel())
        times.append((of_one[:, None] * of_two[None, :]).ravel())
        group.append(np.full(len(keys[-1]), g))
    return np.concatenate(keys), np.concatenate(times), np.concatenate(group)


@functools.lru_cache(maxsize=2)
def _labels(n: int) -> pa.Array:
    """Every id followed by a comma, a bar or a semicolon."""
    return pa.array([f"{i}{mark}" for i in range(n) for mark in ",|;"], pa.large_string())


def group_texts(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all groups, and where the part of each token of ``a`` and ``b``, in that order, ends."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    codes = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + np.repeat(cut_b - size_b, size_a)
    place_b = np.arange(len(b)) + np.repeat(cut_a, size_b)
    codes[place_a] = 3 * a
    codes[place_b] = 3 * b
    codes[place_a[cut_a - 1]] += 1
    codes[place_b[cut_b - 1]] += 2
    labels = _labels(max(1 << 16, 1 + int(codes.max(initial=0)) // 3)).take(pa.array(codes))
    offsets = np.frombuffer(labels.buffers()[1], np.int64)[1 : len(codes) + 1]
    return memoryview(labels.buffers()[2]), offsets


# blocks -----------------------------------------------------------------------------------

_DOCUMENT = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_RESULT = [*_DOCUMENT[:5], ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())]
_RESULT_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
# heads: per document its results and number of pairs; places, times: of all pairs, one document after the other
_BLOCK = pa.schema([("block", pa.int64()), ("heads", pa.string()), ("places", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))])
_BLOCK_SQL = "block long, heads string, places binary, times binary, pairs array<long>, docs array<int>"


def block_row(number: int, doc_ids: list[int | None], texts: list[bytes], tokenizers: Tokenizers) -> pa.RecordBatch:
    """The stored row of a block of documents."""
    used = [i for i, t in enumerate(texts) if t]
    a, b, end_a, end_b, _ = encode_texts([texts[i] for i in used], tokenizers) if used else [np.zeros(0, np.int64)] * 5
    cut_a, cut_b = groups(*(np.cumsum(n[x]) for n, x in zip(tokenizers.lengths, (a, b))), end_a, end_b)
    text, offsets = group_texts(a, b, cut_a, cut_b)
    # Documents end with a group: number of groups up to the end of each.
    groups_to = np.searchsorted(cut_a, end_a, side="right")
    keys, times, group = links(a, b, cut_a, cut_b)
    owner = np.searchsorted(groups_to, group, side="right")
    n_links = np.bincount(owner, weights=times, minlength=len(used)).astype(np.int64) if len(times) else np.zeros(len(used), np.int64)
    heads: list[list] = [[doc_id, 0, 0, 0, 0, "", 0] for doc_id in doc_ids]
    # Ids of either tokenizer fit into 16 bits: one number orders entries by document, then by pair.
    packed = owner << 32 | keys >> 16 | keys & 0xFFFF
    if times.max(initial=1) > 1:
        order = np.argsort(packed)
        packed, times = packed[order], times[order]
    else:
        packed.sort()
    # Occurrences of a pair within a document become one entry.
    at = np.flatnonzero(np.diff(packed, prepend=-1))
    times = np.add.reduceat(times, at) if len(at) else times
    owner, pair = packed[at] >> 32, packed[at] & 0xFFFFFFFF
    pairs = np.sort(pair)
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]
    place = np.searchsorted(pairs, pair)
    entries = np.bincount(owner, minlength=len(used))
    from_a, from_b, from_groups, from_text = 0, 0, 0, 0
    for k, i in enumerate(used):
        to_a, to_b, to_groups = int(end_a[k]), int(end_b[k]), int(groups_to[k])
        if to_a == from_a:
            continue
        to_text = int(offsets[to_a + to_b - 1])
        digest = hashlib.sha256(text[from_text : to_text - 1]).hexdigest()
        heads[i][1:] = [to_a - from_a, to_b - from_b, to_groups - from_groups, int(n_links[k]), digest, int(entries[k])]
        from_a, from_b, from_groups, from_text = to_a, to_b, to_groups, to_text
    docs = np.bincount(place, minlength=len(pairs)).astype(np.int32)
    pairs = pairs >> 16 << 32 | pairs & 0xFFFF
    values = ([number], [json.dumps(heads)], [place.astype(np.int32).tobytes()], [times.tobytes()], [pairs], [docs])
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _BLOCK)], schema=_BLOCK)


def encode_blocks(docs: DataFrame, folder: str, block_bytes: int, idx: str, text: str) -> DataFrame:
    # The files are a few megabytes; tasks get their contents, so that only the driver needs the folder.
    contents = docs.sparkSession.sparkContext.broadcast(tuple((Path(folder) / name).read_bytes() for name in (FIRST, SECOND)))

    def valid(body: bytes | None) -> bytes:
        try:
            return (body or b"").decode().encode()
        except UnicodeDecodeError:
            return b""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(*contents.value)
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for part in slices(parts):
            for doc_id, body in zip(part.column(0).to_pylist(), part.column(1)):
                ids.append(doc_id)
                texts.append(valid(body.as_py()))
                size += len(texts[-1]) + 64
                if size >= block_bytes:
                    yield block_row(number, ids, texts, tokenizers)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield block_row(number, ids, texts, tokenizers)

    chosen = docs.select(F.col(idx).cast("long").alias("doc_id"), F.encode(F.col(text), "UTF-8").alias("body"))
    return chosen.mapInArrow(run, _BLOCK_SQL)


def align(docs: DataFrame, folder: str = FOLDER, block_bytes: int = BLOCK_BYTES, idx: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the numbers of tokens, groups and links of both tokenizers, the links whose id pair
    is the most frequent one of its first id (ties included), and the sum of their pairs' document counts."""
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment")
    encode_blocks(docs, folder, block_bytes, idx, text).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.parquet(path)
    held = blocks.select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n"))
    # One row per id of the first tokenizer, some 50,000 at most.
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("top"))
    rated = counts.join(F.broadcast(highest), F.shiftright("pair", 32) == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    answers = held.select("block", "pair").join(rated, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("x"))
    answers = answers.select("block", F.col("x.pair").alias("pair"), F.col("x.n").alias("n"), F.col("x.best").alias("best"))
    schema = pa.schema(_RESULT)

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(part.num_rows):
                heads, place, times, pair, n, best = (part.column(c)[at] for c in range(6))
                heads = json.loads(heads.as_py())
                place, times = np.frombuffer(place.as_py(), np.int32), np.frombuffer(times.as_py(), np.int64)
                order = np.argsort(pair.values.to_numpy()) if pair.is_valid else np.zeros(0, np.int64)
                n = n.values.to_numpy()[order][place] if len(order) else np.zeros(0, np.int64)
                top = best.values.to_numpy(zero_copy_only=False)[order][place] if len(order) else np.zeros(0, bool)
                cuts = np.cumsum([0, *(head[-1] for head in heads)])
                sums = [np.append(0, np.cumsum(x)) for x in (times * top, times * n)]
                n_best, count_sum = (s[cuts[1:]] - s[cuts[:-1]] for s in sums)
                columns = [*zip(*(head[:-2] for head in heads))]
                columns += [n_best, count_sum, [head[-2] for head in heads]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    joined = blocks.select("block", "heads", "places", "times").join(answers, "block", "left")
    return joined.select("heads", "places", "times", "pair", "n", "best").mapInArrow(finish, _RESULT_SQL)
