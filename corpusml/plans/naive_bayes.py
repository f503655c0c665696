"""Naive Bayes over labelled documents: counting, priors, scoring, accuracy.

Documents are ``(doc_id, labels array<string>, text)``. The default model gives every label of
a document its words, smooths all labels and predicts the most likely one. ``compat=True``
reproduces the older rule instead: only the first label of a document gets its words, only
labels that share a word with the document are scored, the *lowest* score wins, and documents
without a known word are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.functions.text import ENGLISH_STOP_WORDS, digest_bits, find_words
from corpusml.operators.blocks import in_blocks, meet
from corpusml.operators.groups import count_groups, roll_up_counters, sum_groups
from corpusml.operators.ranking import hashed_rank, top_k
from corpusml.operators.rows import label_words
from corpusml.session import ship_package
from corpusml.storage import materialize

STOP_BYTES = frozenset(w.encode() for w in ENGLISH_STOP_WORDS)


@dataclass(frozen=True)
class Counts:
    """The count tables of a model.

    ``words`` is ``(label, word, n)``; ``labels`` is ``(label, n)``, documents per label.
    """

    words: DataFrame
    labels: DataFrame
    compat: bool = False

    def label_words(self) -> DataFrame:
        """``(label, n)``: word occurrences per label, 0 for a label without any."""
        by_word = self.words.select("label", "n")
        none = self.labels.select("label", F.lit(0).cast("long").alias("n"))
        return by_word.union(none).groupBy("label").agg(F.sum("n").alias("n"))

    def totals(self) -> DataFrame:
        """One row: number of labels, label occurrences, distinct words."""
        labels = self.labels.agg(F.count(F.lit(1)).alias("num_labels"), F.sum("n").alias("label_total"))
        vocabulary = self.words.select("word").distinct().agg(F.count(F.lit(1)).alias("vocabulary"))
        return labels.withColumn("vocabulary", vocabulary.scalar())

    def stored(self) -> Counts:
        """The same model with its tables written out, for use by several jobs."""
        return Counts(materialize(self.words, "nb-words"), materialize(self.labels, "nb-labels"), self.compat)


def count(docs: DataFrame, content_only: bool = True, compat: bool = False) -> Counts:
    """Training counts. ``content_only`` lower-cases words and drops stop words."""
    labels = count_groups(docs.select(F.explode("labels").alias("label")), ["label"])
    if compat:
        docs = docs.withColumn("labels", F.slice("labels", 1, 1))
    rows = label_words(counted_words(docs, content_only), F.array("word"), "n")
    return Counts(sum_groups(rows, ["label", "word"], "n", "n"), labels, compat)


#: Distinct words that a task counts before their counts leave it.
_COUNTED = 1_000_000


def counted_words(docs: DataFrame, content_only: bool = True) -> DataFrame:
    """``(labels, word, n)``: occurrences of words in texts with the same labels.

    A task counts them together first, so what is exploded by label and grouped are distinct words.
    """
    ship_package(docs.sparkSession)
    keys = docs.select("labels").schema.simpleString()[len("struct<") : -1].replace("labels:", "labels ", 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, Counter] = {}

        def counted(kind: pa.DataType) -> pa.RecordBatch:
            of: list[int] = []
            found: list[bytes] = []
            n: list[int] = []
            for at, counts in enumerate(known.values()):
                if content_only:
                    for w in STOP_BYTES & counts.keys():
                        del counts[w]
                of += [at] * len(counts)
                found += counts.keys()
                n += counts.values()
            labels = pa.array(list(known), kind).take(pa.array(of, pa.int64()))
            known.clear()
            columns = [labels, pa.array(found, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["labels", "word", "n"])

        kind, size = None, 0
        for part in parts:
            kind = part.column("labels").type
            for own, raw in zip(part.column("labels").to_pylist(), part.column("raw").to_pylist()):
                if own and raw:
                    counts = known.setdefault(tuple(own), Counter())
                    before = len(counts)
                    counts.update(find_words(raw.lower() if content_only else raw))
                    size += len(counts) - before
                    if size > _COUNTED:
                        yield counted(kind)
                        size = 0
        if known:
            yield counted(kind)

    return docs.select("labels", F.col("text").cast("binary").alias("raw")).mapInArrow(run, f"{keys}, word string, n long")


def counters(docs: DataFrame) -> DataFrame:
    """Counters of case-kept words at four levels, see :func:`roll_up_counters`."""
    model = count(docs, content_only=False)
    return roll_up_counters(model.words, model.labels)


def top_words(word_counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent words of each label; ties go to the smaller word."""
    return top_k(word_counts, "label", [F.desc("n"), F.asc("word")], k)


def word_lists(model: Counts) -> DataFrame:
    """``(word, entries)``: for each word the labels it occurs with and their counts.

    One row per word, no longer than the number of labels.
    """
    entries = F.sort_array(F.collect_list(F.struct("label", "n"))).alias("entries")
    return model.words.groupBy("word").agg(entries)


def label_model(model: Counts) -> DataFrame:
    """Per label: log prior and the log of its smoothed word total."""
    per_label = model.labels.withColumnRenamed("n", "documents").join(
        model.label_words().withColumnRenamed("n", "word_total"), "label"
    )
    with_totals = per_label.withColumn("t", model.totals().select(F.struct("*")).scalar())
    prior = F.log(F.col("documents") + 1.0) - F.log(F.col("t.label_total") + F.col("t.num_labels"))
    floor = F.log(F.col("word_total") + F.col("t.vocabulary"))
    return with_totals.select("label", prior.alias("prior"), floor.alias("floor"))


def number_labels(table: DataFrame, width: int) -> DataFrame:
    """Add ``block`` and ``place``: labels side by side in blocks of ``width``, any number of them."""
    ranked = hashed_rank(table, digest_bits(F.col("label")), F.col("label"), "_at")
    at = F.col("_at")
    return ranked.select(*table.columns, F.floor(at / width).alias("block"), (at % width).cast("int").alias("place"))


def score(model: Counts, docs: DataFrame, width: int = 64, near: float | None = None) -> DataFrame:
    """``(doc_id, scores)``: the log score of every label of the model, per document, sorted by label.

    With full smoothing a label's score is
    ``prior + sum of log(count + 1) over seen words - known * log(word total + vocabulary)``,
    with ``known`` the words of the document that the model has. Labels a document shares no
    word with therefore need no row of their own.

    Labels stand side by side in blocks of ``width``: one row per word and block that the word has labels in, and one
    row per word that marks it as known. Documents meet them in blocks of their own, each of which fetches a word once.
    With ``near`` only the scores within that distance of the best one are listed, which is what a choice needs.
    """
    ship_package(docs.sparkSession)
    labels = materialize(number_labels(label_model(model), width), "nb-label-model")
    # A task holds a score for every label, and so their few numbers as well.
    listed = sorted(labels.collect(), key=lambda r: r["label"].encode())
    names = pa.array([r["label"] for r in listed], pa.string())
    prior, floor = (np.array([r[c] for r in listed], np.float64) for c in ("prior", "floor"))
    place = {(r["block"], r["place"]): i for i, r in enumerate(listed)}
    width = min(width, max(1, len(listed)))
    # One row per word and block on the model side, so a hot word can be split.
    logs = ", ".join(f"max(if(place = {i}, ln(n + 1D), NULL))" for i in range(width))
    numbered = model.words.join(labels.select("label", "block", "place"), "label")
    vectors = numbered.groupBy("word", "block").agg(F.expr(f"array({logs})").alias("v"))
    marks = model.words.select("word").distinct().select("word", F.lit(-1).cast("long").alias("block"), F.lit(None).cast("array<double>").alias("v"))
    compat = model.compat

    def terms(part: pa.RecordBatch) -> Iterator[set]:
        return (set(find_words(raw.lower())) - STOP_BYTES for raw in part.column("raw").to_pylist())

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        words_of = found.column("word").cast(pa.binary()).to_pylist()
        ids: dict[bytes, int] = {}
        at = np.array([ids.setdefault(w, len(ids)) for w in words_of], np.int64)
        blocks = found.column("block").to_numpy()
        marked = np.zeros(len(ids))
        marked[at[blocks == -1]] = 1.0
        # Rows that share an id are one document; without an id it needs a word to be one.
        docs_at: dict = {}
        tokens = []
        for idx, raw in zip(rows.column("doc_id").to_pylist(), rows.column("raw").to_pylist()):
            own = find_words(raw.lower())
            if idx is None and all(w in STOP_BYTES for w in own):
                continue
            d = docs_at.setdefault(idx, len(docs_at))
            own = np.fromiter(map(ids.get, own, repeat(-1)), np.int64)
            tokens.append(d << 32 | own[own >= 0])
        pairs, tf = np.unique(np.concatenate(tokens) if tokens else np.zeros(0, np.int64), return_counts=True)
        doc, word = pairs >> 32, pairs & 0xFFFFFFFF
        sums = np.zeros((len(docs_at), len(names)))
        known = np.bincount(doc, tf * marked[word], minlength=len(docs_at))
        used = np.zeros(sums.shape) if compat else None
        for block in np.unique(blocks[blocks >= 0]).tolist():
            here = np.flatnonzero(blocks == block)
            flat = _flat_doubles(found.column("v").take(pa.array(here))).reshape(len(here), width)
            table = np.full((len(ids), width), np.nan)
            table[at[here]] = flat
            columns = [(j, place[block, j]) for j in range(width) if (block, j) in place]
            _, to = map(list, zip(*columns))
            seen = ~np.isnan(table)
            sums[:, to] = _weighted_rows(doc, word, tf, np.where(seen, table, 0.0), len(docs_at))[:, : len(to)]
            if compat:
                used[:, to] = _weighted_rows(doc, word, tf, seen.astype(np.float64), len(docs_at))[:, : len(to)]
        scores = sums - (used if compat else known[:, None]) * floor + prior
        keep = used > 0 if compat else np.ones(scores.shape, bool)
        if compat:
            keep &= known[:, None] > 0
        if near is not None and len(names):
            if compat:
                keep &= scores <= np.where(keep, scores, np.inf).min(axis=1, keepdims=True) + near
            else:
                keep &= scores >= scores.max(axis=1, keepdims=True) - near
        of, label = np.nonzero(keep)
        entries = pa.StructArray.from_arrays([names.take(pa.array(label)), pa.array(scores[of, label])], names=["label", "score"])
        offsets = np.cumsum(np.append(0, keep.sum(axis=1)))
        out = pa.table({"doc_id": pa.array(list(docs_at), rows.schema.field("doc_id").type), "scores": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)})
        # The older rule leaves out documents without a known word.
        return out.filter(pa.array(known > 0)) if compat else out

    # Documents without a text have no words to count.
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("raw")).filter(F.col("raw").isNotNull())
    blocked = in_blocks(rows, "doc_id", F.octet_length("raw") + 2 * len(names))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return meet(blocked, terms, "word", "string", vectors.union(marks), run, f"doc_id {id_type}, scores array<struct<label: string, score: double>>")


def _flat_doubles(column: pa.ChunkedArray) -> np.ndarray:
    """Values of a column of lists, one after the other; NaN for NULL."""
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])


def _weighted_rows(doc: np.ndarray, word: np.ndarray, tf: np.ndarray, table: np.ndarray, docs: int) -> np.ndarray:
    """For each document the sum of the rows of its words, times their numbers. Entries come sorted by document."""
    out = np.zeros((docs, table.shape[1]))
    for at in range(0, len(doc), 1 << 16):
        own = slice(at, at + (1 << 16))
        starts = np.flatnonzero(np.diff(doc[own], prepend=-1))
        out[doc[own][starts]] += np.add.reduceat(table[word[own]] * tf[own, None], starts, axis=0)
    return out


def predict(model: Counts, docs: DataFrame) -> DataFrame:
    """``(doc_id, label, score)``: the chosen label of each document and its log score.

    Scores that agree to nine digits tie, and the smaller label wins.
    """
    scored = score(model, docs, near=1e-8)
    direction = 1 if model.compat else -1
    ranked = F.transform(
        "scores", lambda s: F.struct((F.round(s["score"], 9) * direction).alias("key"), s["label"].alias("label"), s["score"].alias("score"))
    )
    best = F.array_min(ranked)
    chosen = scored.select("doc_id", best.alias("best")).select("doc_id", "best.label", "best.score")
    if not model.compat:
        return chosen
    # The older rule starts from score 0 under a placeholder label and only accepts less.
    lower = F.col("score") < 0
    return chosen.select(
        "doc_id",
        F.when(lower, F.col("label")).otherwise("label").alias("label"),
        F.when(lower, F.col("score")).otherwise(0.0).alias("score"),
    )
