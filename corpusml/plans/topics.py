"""Topic modelling by distributed collapsed Gibbs sampling.

The state is ``(doc_id, words array<int>, z array<int>)``: a topic for every word position. One
sync resamples one sub-batch of the documents against counts frozen at the start of the sync;
inside a document every new topic counts at once. Then the counts of that sub-batch are built
anew. Random numbers depend on seed, sweep, document and position alone, so neither
partitioning nor a lost executor changes the result.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.functions.text import digest_bits, distinct_words, find_words
from corpusml.functions.vectors import log_gamma
from corpusml.operators.blocks import in_blocks, meet
from corpusml.operators.ranking import hashed_rank, top_k
from corpusml.session import ship_package
from corpusml.storage import discard, materialize


@dataclass(frozen=True)
class Settings:
    topics: int = 10
    alpha: float = 0.1
    beta: float = 0.1
    sweeps: int = 10
    clocks: int = 1
    seed: int = 0


# documents as word ids --------------------------------------------------------------------

def vocabulary(tokens: DataFrame) -> DataFrame:
    """``(word, word_id)`` with contiguous ids from 0, in order of the words' hashes, stored.

    Takes rows with a ``word`` or documents with a ``text``. A vocabulary grows with the corpus, so ids come from a rank
    that no single task computes.
    """
    found = tokens.select("word") if "word" in tokens.columns else distinct_words(tokens)
    ranked = hashed_rank(found.distinct(), digest_bits(F.col("word")), F.col("word"), "word_id")
    # Readers join it more than once.
    return materialize(ranked, "topics-vocabulary")


def word_id_documents(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(doc_id, words array<int>)`` in order of position, of documents that have words.

    Takes ``(doc_id, pos, word)`` rows, or documents ``(doc_id, text)`` as they are: those are numbered in blocks, so that
    no row per token is shuffled. Rows that share an id are one document.
    """
    if "text" in tokens.columns:
        return _numbered_texts(tokens, vocab)
    ids = tokens.join(vocab, "word").select("doc_id", F.struct("pos", F.col("word_id").cast("int").alias("word_id")).alias("at"))
    # A list per document, as long as the document.
    listed = ids.groupBy("doc_id").agg(F.sort_array(F.collect_list("at")).alias("at"))
    return listed.select("doc_id", F.col("at.word_id").alias("words"))


def _numbered_texts(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def terms(part: pa.RecordBatch) -> Iterator[set]:
        return (set(find_words(raw)) for raw in part.column("raw").to_pylist())

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        ids = dict(zip(found.column("word").cast(pa.binary()).to_pylist(), found.column("word_id").to_pylist()))
        lists: dict = {}
        for idx, raw in zip(rows.column("doc_id").to_pylist(), rows.column("raw").to_pylist()):
            own = np.fromiter(map(ids.__getitem__, find_words(raw)), np.int32)
            if len(own):
                lists.setdefault(idx, []).append(own)
        merged = [x[0] if len(x) == 1 else _interleaved(x) for x in lists.values()]
        return pa.table({"doc_id": pa.array(list(lists), rows.schema.field("doc_id").type), "words": _lists(merged)})

    # NULL texts have no words.
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("raw")).filter(F.col("raw").isNotNull())
    blocked = in_blocks(raw, "doc_id", F.octet_length("raw"))
    return meet(blocked, terms, "word", "string", vocab, run, f"doc_id {id_type}, words array<int>")


def _interleaved(lists: list[np.ndarray]) -> np.ndarray:
    """Lists of one document as one, in order of position and then of word id."""
    places = np.concatenate([np.arange(len(x)) for x in lists])
    ids = np.concatenate(lists)
    return ids[np.lexsort((ids, places))]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *[len(a) for a in arrays]])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a column of lists."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), lengths


def num_words(docs: DataFrame) -> int:
    """Largest word id plus one."""
    return docs.agg(F.max(F.array_max("words")) + 1).first()[0] or 0


# counts -----------------------------------------------------------------------------------

def initial_topics(docs: DataFrame, topics: int, seed: int = 0) -> DataFrame:
    """Add ``z``: a topic for every position, drawn by a digest of seed, document and position."""

    def draw(_: Column, i: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), i.cast("string"))
        return (digest_bits(text) % topics).cast("int")

    return docs.withColumn("z", F.transform("words", draw))


#: Tokens that are counted together before their counts leave a task.
_COUNTED = 4 << 20


def word_topic_counts(state: DataFrame) -> DataFrame:
    """``(word_id, topic, n)``; tokens are counted in batches first, so what is grouped are distinct pairs."""
    ship_package(state.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            columns = [(pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word_id", "topic", "n"])

        for part in parts:
            words, z = (_flat(pa.chunked_array([part.column(c)]))[0].astype(np.int64) for c in ("words", "z"))
            held.append(words << 32 | z)
            size += len(words)
            if size > _COUNTED:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    pairs = state.select("words", "z").mapInArrow(run, "word_id int, topic int, n long")
    return pairs.groupBy("word_id", "topic").agg(F.sum("n").alias("n"))


def topic_counts(word_topics: DataFrame) -> DataFrame:
    return word_topics.groupBy("topic").agg(F.sum("n").alias("n"))


def document_topic_counts(state: DataFrame) -> DataFrame:
    """``(doc_id, topic, n)``; counted inside the row first."""
    ship_package(state.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            z, lengths = _flat(pa.chunked_array([part.column("z")]))
            pairs, n = np.unique(np.repeat(np.arange(len(lengths)), lengths) << 32 | z.astype(np.int64), return_counts=True)
            columns = [part.column("doc_id").take(pa.array(pairs >> 32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "topic", "n"])

    id_type = state.schema["doc_id"].dataType.simpleString()
    pairs = state.select("doc_id", "z").mapInArrow(run, f"doc_id {id_type}, topic int, n long")
    return pairs.groupBy("doc_id", "topic").agg(F.sum("n").alias("n"))


# likelihood -------------------------------------------------------------------------------

def _rising(counts: DataFrame, column: str, base: float) -> DataFrame:
    """One row: sum of ``log_gamma(n + base) - log_gamma(base)`` over a count column.

    Counts repeat a lot, so the function is computed once per distinct value.
    """
    histogram = counts.groupBy(F.col(column).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    gain = log_gamma(F.col("n") + F.lit(base)) - log_gamma(F.lit(base) + F.col("n") * 0.0)
    return histogram.select((F.col("rows") * gain).alias("gain")).agg(F.coalesce(F.sum("gain"), F.lit(0.0)).alias("gain"))


def log_likelihood(word_topics: DataFrame, doc_topics: DataFrame, words: int, s: Settings) -> DataFrame:
    """One row ``(topic_part, document_part, likelihood)``.

    Cells with count 0 cancel against the normalizing constants, so only the sparse count
    tables are read.
    """
    ship_package(word_topics.sparkSession)
    by_topic = topic_counts(word_topics)
    by_doc = doc_topics.groupBy("doc_id").agg(F.sum("n").alias("n"))
    word_gain = _rising(word_topics, "n", s.beta).scalar()
    topic_loss = _rising(by_topic, "n", s.beta * words).scalar()
    doc_gain = _rising(doc_topics, "n", s.alpha).scalar()
    doc_loss = _rising(by_doc, "n", s.alpha * s.topics).scalar()
    one = word_topics.sparkSession.range(1)
    parts = one.select((word_gain - topic_loss).alias("topic_part"), (doc_gain - doc_loss).alias("document_part"))
    return parts.withColumn("likelihood", F.col("topic_part") + F.col("document_part"))


# sampling ---------------------------------------------------------------------------------

_U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    # Finalizer of the public splitmix64 generator.
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _uniform(keys: np.ndarray, positions: np.ndarray, stream: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salted = _mix(keys + _U64(stream) * _U64(0x9E3779B97F4A7C15))
        bits = _mix(salted + (positions + 1).astype(_U64) * _U64(0x9E3779B97F4A7C15))
    return (bits >> _U64(11)).astype(np.float64) / float(1 << 53)


def _entries(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the entries of ragged rows, one row after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(first - ends + sizes, sizes)


class _Pairs:
    """Rows of (topic, count) pairs, one row per document and word, in order of topic.

    A row has room for the topics of the model and for those that the word can still get in its document.
    """

    def __init__(self, sizes: np.ndarray, topics: np.ndarray, counts: np.ndarray, uses: np.ndarray, num_topics: int) -> None:
        # A word that the model lacks has one pair without weight.
        self.sizes = np.maximum(sizes, 1).astype(np.int64)
        room = np.minimum(self.sizes + uses, num_topics)
        self.first = np.cumsum(room) - room
        self.topics = np.zeros(int(room.sum()), np.int64)
        self.counts = np.zeros(len(self.topics))
        at = _entries(self.first, sizes.astype(np.int64))
        self.topics[at] = topics
        self.counts[at] = counts

    def insert(self, rows: np.ndarray, topics: np.ndarray) -> None:
        """Add topics that the rows do not have yet, with count 1, in their places."""
        sizes = self.sizes[rows]
        at = _entries(self.first[rows], sizes)
        later = self.topics[at] > np.repeat(topics, sizes)
        moved = at[later]
        self.topics[moved + 1], self.counts[moved + 1] = self.topics[moved], self.counts[moved]
        behind = np.zeros(len(rows), np.int64)
        np.add.at(behind, np.repeat(np.arange(len(rows)), sizes)[later], 1)
        place = self.first[rows] + sizes - behind
        self.topics[place], self.counts[place] = topics, 1.0
        self.sizes[rows] += 1


# The word term of a row is cut into this many parts of its largest weight, so that running sums over many rows are
# exact and no row depends on its neighbours. Cells of a block times this number stay below 2 ** 62.
_PARTS = float(1 << 38)


def resample(
    keys: np.ndarray, words: list, z: list, distinct: list, sizes: np.ndarray, topics: np.ndarray, counts: np.ndarray,
    totals: np.ndarray, num_words: int, stream: int, s: Settings,
) -> list[np.ndarray]:
    """New topics for a block of documents.

    ``distinct`` lists the sorted distinct words of each document; ``sizes``, ``topics`` and ``counts`` are the
    (topic, count) pairs of those words, one row per document and word, frozen at the start of the sync. Each document
    changes its own rows only. All documents of the block advance together, one position at a time, longest
    first. They do not see each other's changes, so it does not matter which block they are in.

    The weight of a topic, ``(own + alpha) * (word + beta) / (total + beta * num_words)``, is the sum of a word term
    ``(own + alpha) * word`` and a rest ``(own + alpha) * beta`` over the same denominator. The word term has the pairs of
    the word only. The sum of the rest is kept up to date per document, and it is laid out over the topics only for the
    documents whose draw falls into it.
    """
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    starts = np.cumsum(sorted_lengths) - sorted_lengths
    offsets = np.cumsum([0, *[len(d) for d in distinct]])
    slot = np.concatenate([offsets[d] + np.searchsorted(distinct[d], words[d]) for d in order]).astype(np.int64)
    topic = np.concatenate([z[d] for d in order]).astype(np.int64)
    owner = np.repeat(np.arange(len(order)), sorted_lengths)
    u = _uniform(keys[order].astype(np.int64).view(_U64)[owner], np.arange(len(slot)) - starts[owner], stream)
    pairs = _Pairs(sizes, topics, counts, np.bincount(slot, minlength=len(sizes)), s.topics)
    # Per document and topic, flat: own tokens plus alpha, and the denominator.
    cells = np.arange(len(order)) * s.topics
    own = np.bincount(cells[owner] + topic, minlength=len(order) * s.topics) + s.alpha
    below = np.tile(totals.astype(np.float64) + s.beta * num_words, len(order))
    rest = (s.beta * own / below).reshape(len(order), s.topics).sum(axis=1)

    def change(cell: np.ndarray, step: float) -> None:
        n, total = own[cell], below[cell]
        after, total_after = n + step, total + step
        rest[: len(cell)] += s.beta * (after / total_after - n / total)
        own[cell], below[cell] = after, total_after

    for i in range(int(lengths.max(initial=0))):
        active = int(np.searchsorted(-sorted_lengths, -i, side="left"))
        at, cell = starts[:active] + i, cells[:active]
        here, old = slot[at], topic[at]
        change(cell + old, -1.0)
        wide = pairs.sizes[here]
        ends = wide.cumsum()
        begins = ends - wide
        of = np.arange(active).repeat(wide)
        entry = np.arange(len(of)) + (pairs.first[here] - begins)[of]
        k = pairs.topics[entry]
        n = pairs.counts[entry] - (k == old[of])
        flat = cell[of] + k
        weight = own[flat] * n / below[flat]
        # A word without any weight has no parts.
        scale = _PARTS / np.maximum(np.maximum.reduceat(weight, begins), 1e-200)
        running = (weight * scale[of]).astype(np.int64).cumsum()
        through = running[ends - 1]
        base = np.concatenate(([0], through[:-1]))
        parts = through - base
        word = parts / scale
        x = u[at] * (word + rest[:active])
        by_word, by_rest = np.flatnonzero(x < word), np.flatnonzero(x >= word)
        new = np.empty(active, np.int64)
        wanted = base[by_word] + np.minimum((x[by_word] * scale[by_word]).astype(np.int64), parts[by_word] - 1)
        new[by_word] = k[running.searchsorted(wanted, side="right")]
        if len(by_rest):
            wide_cells = cell[by_rest, None] + np.arange(s.topics)
            sums = (s.beta * own[wide_cells] / below[wide_cells]).cumsum(axis=1)
            # Rounding can leave x at the very end: the last topic then.
            new[by_rest] = np.minimum((sums <= (x - word)[by_rest, None]).sum(axis=1), s.topics - 1)
        change(cell + new, 1.0)
        kept = k == new[of]
        pairs.counts[entry] = n + kept
        if np.count_nonzero(kept) < active:
            missing = ~np.logical_or.reduceat(kept, begins)
            pairs.insert(here[missing], new[missing])
        topic[at] = new
    out: list = [None] * len(order)
    for place, d in enumerate(order):
        out[d] = topic[starts[place] : starts[place] + lengths[d]].astype(np.int32)
    return out


# Numbers in the working tables of one block; about 64 MB.
_BLOCK_CELLS = 8 << 20


def _blocks(cells: list[int]) -> Iterator[slice]:
    begin, total = 0, 0
    for i, n in enumerate(cells):
        total += n
        if total > _BLOCK_CELLS:
            yield slice(begin, i + 1)
            begin, total = i + 1, 0
    if begin < len(cells):
        yield slice(begin, len(cells))


_STATE = "doc_id {id_type}, words array<int>, z array<int>"


def document_key(idx: str = "doc_id") -> Column:
    """The number that a document's draws start from: 60 bits of a digest that other SQL engines have as well."""
    return digest_bits(F.col(idx).cast("string"), 15)


def sample(state: DataFrame, word_topics: DataFrame, words: int, stream: int, s: Settings) -> DataFrame:
    """One pass over the documents of ``state`` against frozen counts.

    The counts stay distributed: each block of documents fetches those of its own words through a join, every word
    once. The model side has one row per word with its (topic, count) pairs. The pairs stay pairs: a block holds no more
    numbers than its words have topics.
    """
    ship_package(state.sparkSession)
    totals = np.zeros(s.topics)
    for row in topic_counts(word_topics).collect():
        totals[row["topic"]] = row["n"]
    # Topics travel as bytes where they fit.
    kind = "array<tinyint>" if s.topics <= 127 else "array<int>"
    packed = word_topics.groupBy(F.col("word_id").cast("long").alias("word_id")).agg(F.sort_array(F.collect_list(F.struct("topic", "n"))).alias("pairs"))
    packed = packed.select("word_id", F.col("pairs.topic").cast(kind).alias("topics"), F.col("pairs.n").cast("array<bigint>").alias("counts"))
    id_type = state.schema["doc_id"].dataType.simpleString()

    def terms(part: pa.RecordBatch) -> Iterator[set]:
        values, lengths = _flat(pa.chunked_array([part.column("words")]))
        return (set(x.tolist()) for x in np.split(values, np.cumsum(lengths)[:-1]))

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        ids = found.column("word_id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        all_topics, wide = _flat(found.column("topics"))
        all_counts = _flat(found.column("counts"))[0]
        first = (np.cumsum(wide) - wide)[order]
        # One more row stands for the words that the model lacks.
        first, wide = np.append(first, 0), np.append(wide[order], 0)
        flat_words, lengths = _flat(rows.column("words"))
        ends = np.cumsum(lengths)
        of_words = np.split(flat_words, ends[:-1])
        of_z = np.split(_flat(rows.column("z"))[0], ends[:-1])
        keys = rows.column("key").to_numpy()

        def places(distinct: np.ndarray) -> np.ndarray:
            at = np.searchsorted(ids, distinct)
            known = at < len(ids)
            known[known] = ids[at[known]] == distinct[known]
            return np.where(known, at, len(ids))

        distinct = [np.unique(w) for w in of_words]
        at = [places(d) for d in distinct]
        new: list = []
        for part in _blocks([int(wide[a].sum()) + 2 * len(w) + 2 * s.topics for a, w in zip(at, of_words)]):
            here = np.concatenate(at[part])
            entries = _entries(first[here], wide[here])
            new += resample(
                keys[part], of_words[part], of_z[part], distinct[part], wide[here], all_topics[entries], all_counts[entries], totals, words, stream, s)
        return pa.table({"doc_id": rows.column("doc_id"), "words": rows.column("words"), "z": _lists(new)})

    rows = state.select("doc_id", document_key().alias("key"), "words", F.col("z").cast(kind).alias("z"))
    # Six bytes for a word, as in a text.
    blocked = in_blocks(rows, "doc_id", F.size("words") * 6)
    return meet(blocked, terms, "word_id", "long", packed, run, _STATE.format(id_type=id_type))


@dataclass(frozen=True)
class Trained:
    state: DataFrame
    word_topics: DataFrame
    history: list[tuple[int, float, float]]


_FEW = 8


def train(docs: DataFrame, words: int, s: Settings, likelihood: bool = True) -> Trained:
    """Run ``s.sweeps`` sweeps of ``s.clocks`` syncs each over ``(doc_id, words)``.

    A sync reads and writes one sub-batch only. ``history`` has one
    ``(iteration, seconds, likelihood)`` entry per sweep.
    """
    part = (document_key() % s.clocks).cast("int")
    dealt = docs.select("doc_id", "words").withColumn("part", part)
    if s.clocks > _FEW:
        # Before they get topics, which need not travel. A task may write few sub-batches as they come.
        dealt = dealt.hint("rebalance", "part")
    start = materialize(initial_topics(dealt, s.topics, s.seed), "topics-start", ["part"], rebalance=False)
    states = [start.filter(F.col("part") == c).drop("part") for c in range(s.clocks)]
    counts = [materialize(word_topic_counts(x), "topics-counts") for x in states]
    fresh = True
    history, seconds = [], 0.0
    for sweep in range(s.sweeps):
        began = time.monotonic()
        for c in range(s.clocks):
            # Summed up once; the sampler reads it for the totals and for the words.
            total = materialize(_total(counts), "topics-total") if s.clocks > 1 else counts[0]
            new = materialize(sample(states[c], total, words, sweep, s), "topics-state")
            if s.clocks > 1:
                discard(total)
            new_counts = materialize(word_topic_counts(new), "topics-counts")
            if not fresh:
                discard(states[c])
            discard(counts[c])
            states[c], counts[c] = new, new_counts
        if fresh:
            discard(start)
            fresh = False
        seconds += time.monotonic() - began
        if likelihood:
            row = log_likelihood(_total(counts), document_topic_counts(_union(states)), words, s).first()
            history.append((sweep + 1, seconds, row["likelihood"]))
    return Trained(_union(states), _total(counts), history)


def _union(views: list[DataFrame]) -> DataFrame:
    out = views[0]
    for view in views[1:]:
        out = out.unionByName(view)
    return out


def _total(counts: list[DataFrame]) -> DataFrame:
    if len(counts) == 1:
        return counts[0]
    return _union(counts).groupBy("word_id", "topic").agg(F.sum("n").alias("n"))


# reports ----------------------------------------------------------------------------------

def topic_words(word_topics: DataFrame, vocab: DataFrame, k: int = 10) -> DataFrame:
    """``(topic, words array<string>)``: the ``k`` most frequent words of each topic, in order.

    Ties go to the lower word id. A word the topic does not have is never listed; one that the
    vocabulary does not have is listed by its id.
    """
    top = top_k(word_topics, "topic", [F.desc("n"), F.asc("word_id")], k)
    named = top.join(vocab, "word_id", "left").withColumn("word", F.coalesce("word", F.col("word_id").cast("string")))
    named = named.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("at"))
    return named.select("topic", F.col("at.word").alias("words"))
