"""Quality scores from supervised subword embeddings.

Words, pairs of words and character n-grams of the whole text are hashed into a fixed number of
buckets. Every bucket has a learned vector, a document is the average of the vectors of its
features, and a softmax layer turns the average into class probabilities. Vectors and layer are
trained by plain stochastic gradient descent in numpy on a bounded sample of labelled rows
(``TRAIN_ROWS``), in one Spark task; everything else covers all rows.

Scoring needs no vectors: averaging and the layer are both linear, so each bucket is reduced to
one number, the difference of its two class scores, and a document's score is the logistic of
their mean. That table has ``2 ** BITS`` floats whatever the corpus holds, so it is broadcast.
Scoring is a map over the documents without any shuffle.

A null or empty text has no features and gets the score of the output bias; without any labelled
row every score is 0.5; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import as_bytes, byte_sums, prefix_sums, run_hashes, stretch_hashes, utf8, word_spans
from corpusml.llm.labels import held_out, training_sample

BITS = 17
DIMENSIONS = 8
GRAMS = (3,)
TRAIN_ROWS = 4000
EPOCHS = 12
RATE = 2.0
THRESHOLD = 0.3


def features(raw: np.ndarray) -> np.ndarray:
    """Bucket of every feature of a text, repeats included."""
    if not len(raw):
        return np.zeros(0, np.int64)
    sums = byte_sums(raw)
    starts, ends = word_spans(raw)
    words = stretch_hashes(sums, starts, ends)
    found = [run_hashes(sums, n) for n in GRAMS] + [words + np.uint64(1), run_hashes(prefix_sums(words), 2)]
    buckets = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    # A word that repeats its neighbour is a feature of its own, whatever the word is.
    return np.concatenate([buckets, np.zeros(int((words[1:] == words[:-1]).sum()), np.int64)])


def train(texts: list[bytes], labels: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Score of every bucket and the bias, after gradient descent over the labelled texts."""
    scores = np.zeros(1 << BITS, np.float32)
    if not len(texts):
        return scores, 0.0
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    rate_of_ones = (labels.sum() + 1) / (len(labels) + 2)
    bias = np.log([1 - rate_of_ones, rate_of_ones]).astype(np.float32)
    rows = []
    for text in texts:
        ids, counts = np.unique(features(as_bytes(text)), return_counts=True)
        rows.append((ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            ids, shares = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            own = vectors[ids]
            hidden = shares @ own
            raw = hidden @ layer + bias
            odds = np.exp(raw - raw.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= 0.05 * rate * error
            # The average splits the gradient; scaling it up keeps rare features learning.
            vectors[ids] = own - np.float32(rate) * np.outer(np.sqrt(shares), back).astype(np.float32)
    scores = vectors @ (layer[:, 1] - layer[:, 0])
    return scores.astype(np.float32), float(bias[1] - bias[0])


def fit(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Train on ``(doc_id, text, label)`` rows in one task; the sample is bounded by its maker."""

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "label", "raw"], kind="stable")
        scores, bias = train(list(rows["raw"]), rows["label"].to_numpy(int))
        return pd.DataFrame({"scores": [scores.tobytes()], "bias": [bias]})

    trained = sample.select("doc_id", utf8("text").alias("raw"), "label", F.lit(0).alias("one"))
    got = trained.groupBy("one").applyInPandas(learn, "scores binary, bias double").collect()
    if not got:
        return np.zeros(1 << BITS, np.float32), 0.0
    return np.frombuffer(got[0]["scores"], np.float32), got[0]["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], idx: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        scores, bias = shared.value
        for part in parts:
            values = np.empty(part.num_rows)
            for i, raw in enumerate(part.column("raw")):
                ids = features(as_bytes(raw.as_py()))
                values[i] = bias + (scores[ids].mean(dtype=np.float64) if len(ids) else 0.0)
            values = 1 / (1 + np.exp(-np.clip(values, -700, 700)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    rows = docs.select(F.col(idx).cast("long").alias("doc_id"), utf8(text).alias("raw"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(training_sample(docs, labels, "quality", TRAIN_ROWS)))
