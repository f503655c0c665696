"""Perceptron and LSTM character classifiers, trained by synchronous data-parallel SGD.

Spark holds and partitions the examples. One step broadcasts the parameters, lets every
partition compute its summed gradient in Arrow batches, adds the partial gradients up and applies
the step on the driver. A gradient travels in chunks of ``CHUNK`` numbers, one row each, which are added in two
levels: the partitions of a lane first, then the lanes. Only parameters and their gradient, whose size
the model fixes, ever reach the driver; the result does not depend on the partitioning.

Losses are appended to a table and the parameters of every epoch are stored while training goes on; the best
epoch is chosen by an aggregate over that table.

Parameters are a plain ``dict`` of numpy arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.plans import batches
from corpusml.plans.characters import steps, target, window_of
from corpusml.operators.rows import spread
from corpusml.session import ship_package
from corpusml.storage import discard, materialize, scratch_path

Parameters = dict[str, np.ndarray]

#: Gradient entries that travel in one row.
CHUNK = 32
#: Groups of partitions whose gradients are added before all others.
LANES = 64
# The chunk that holds the summed loss and the number of rows.
TOTALS = -1
_LOSSES = "kind string, step int, loss double"


@dataclass(frozen=True)
class Shape:
    num_chars: int
    num_labels: int
    max_len: int = 10
    hidden: int = 50


@dataclass(frozen=True)
class Settings:
    epochs: int = 15
    batch_size: int = 64
    learning_rate: float = 0.5
    seed: int = 0
    steps: int | None = None
    max_parameter_bytes: int = 512 << 20


@dataclass(frozen=True)
class Trained:
    """The parameters of the best validation epoch and the course of training.

    ``losses`` is ``(kind, step, loss)``: "train" rows by step, "valid" rows by epoch.
    """

    parameters: Parameters
    losses: DataFrame

    def series(self, kind: str) -> DataFrame:
        """``(step, loss)`` of the "train" or "valid" losses."""
        return self.losses.filter(F.col("kind") == kind).select("step", "loss")


def best_epoch(losses: DataFrame) -> DataFrame:
    """``(epoch, loss)``: the first of the epochs with the lowest validation loss; no row without any."""
    valid = losses.filter(F.col("kind") == "valid")
    best = valid.agg(F.min(F.struct("loss", "step")).alias("b"))
    return best.filter(F.col("b").isNotNull()).select(F.col("b.step").alias("epoch"), F.col("b.loss").alias("loss"))


# models ---------------------------------------------------------------------------------
#
# A model is ``(parameters, inputs, targets) -> (log probabilities, gradient or None)`` for a block
# of rows. Inputs are character ids, -1 where a name has ended: that position contributes
# nothing, as a zero row of a one-hot matrix would.

def _glorot(rng: np.random.Generator, rows: int, columns: int) -> np.ndarray:
    bound = np.sqrt(6.0 / (rows + columns))
    return rng.uniform(-bound, bound, (rows, columns))


def _bias(rng: np.random.Generator, size: int) -> np.ndarray:
    return rng.uniform(-0.1, 0.1, size)


def mlp_parameters(shape: Shape, seed: int = 0) -> Parameters:
    rng = np.random.default_rng(seed)
    return {
        "w1": _glorot(rng, shape.max_len * shape.num_chars, shape.hidden),
        "b1": _bias(rng, shape.hidden),
        "w2": _glorot(rng, shape.hidden, shape.num_labels),
        "b2": _bias(rng, shape.num_labels),
    }


def _head(p: Parameters, hidden: np.ndarray):
    # The output layer is rectified before the softmax.
    raw = hidden @ p["w2"] + p["b2"]
    logits = np.maximum(raw, 0.0)
    shifted = logits - logits.max(axis=1, keepdims=True)
    # Logarithms straight from the logits: a probability may round to 0, its logarithm stays finite.
    return raw, shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))


def _head_gradient(p: Parameters, hidden: np.ndarray, raw: np.ndarray, logs: np.ndarray, y: np.ndarray):
    error = (np.exp(logs) - y) * (raw > 0)
    return {"w2": hidden.T @ error, "b2": error.sum(axis=0)}, error @ p["w2"].T


def mlp(p: Parameters, x: np.ndarray, y: np.ndarray | None):
    positions = x.shape[1]
    used = x >= 0
    rows = np.arange(positions) * (p["w1"].shape[0] // positions) + np.where(used, x, 0)
    raw1 = (p["w1"][rows] * used[..., None]).sum(axis=1) + p["b1"]
    hidden = np.maximum(raw1, 0.0)
    raw2, logs = _head(p, hidden)
    if y is None:
        return logs, None
    grad, back = _head_gradient(p, hidden, raw2, logs, y)
    back = back * (raw1 > 0)
    grad["b1"] = back.sum(axis=0)
    grad["w1"] = np.zeros_like(p["w1"])
    owner, place = np.nonzero(used)
    np.add.at(grad["w1"], rows[owner, place], back[owner])
    return logs, grad


GATES = ("i", "f", "o", "c")


def lstm_parameters(shape: Shape, seed: int = 0) -> Parameters:
    rng = np.random.default_rng(seed)
    # All matrices of the recurrent layer share the bound of its input matrix.
    bound = np.sqrt(6.0 / (shape.num_chars + shape.hidden))
    p: Parameters = {}
    for gate in GATES:
        p["w" + gate] = rng.uniform(-bound, bound, (shape.num_chars, shape.hidden))
        p["u" + gate] = rng.uniform(-bound, bound, (shape.hidden, shape.hidden))
        p["b" + gate] = _bias(rng, shape.hidden)
    p["w2"] = _glorot(rng, shape.hidden, shape.num_labels)
    p["b2"] = _bias(rng, shape.num_labels)
    return p


def _squash(a: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * a))


def lstm(p: Parameters, x: np.ndarray, y: np.ndarray | None):
    size = p["b2"].shape[0], p["bi"].shape[0]
    h = np.zeros((len(x), size[1]))
    cell = np.zeros_like(h)
    trace = []
    for t in range(x.shape[1]):
        used = (x[:, t] >= 0)[:, None]
        ids = np.where(x[:, t] >= 0, x[:, t], 0)
        raw = {g: p["w" + g][ids] * used + h @ p["u" + g] + p["b" + g] for g in GATES}
        gate = {g: np.tanh(raw[g]) if g == "c" else _squash(raw[g]) for g in GATES}
        before, h_before = cell, h
        cell = gate["f"] * before + gate["i"] * gate["c"]
        squashed = np.tanh(cell)
        h = gate["o"] * squashed
        trace.append((gate, before, h_before, squashed))
    raw2, logs = _head(p, h)
    if y is None:
        return logs, None
    grad, back_h = _head_gradient(p, h, raw2, logs, y)
    for g in GATES:
        for kind in "wub":
            grad[kind + g] = np.zeros_like(p[kind + g])
    back_cell = np.zeros_like(h)
    for t in reversed(range(x.shape[1])):
        gate, before, h_before, squashed = trace[t]
        back_cell = back_cell + back_h * gate["o"] * (1.0 - squashed**2)
        error = {
            "i": back_cell * gate["c"] * gate["i"] * (1.0 - gate["i"]),
            "f": back_cell * before * gate["f"] * (1.0 - gate["f"]),
            "o": back_h * squashed * gate["o"] * (1.0 - gate["o"]),
            "c": back_cell * gate["i"] * (1.0 - gate["c"] ** 2),
        }
        used = x[:, t] >= 0
        back_h = np.zeros_like(h)
        for g in GATES:
            np.add.at(grad["w" + g], x[used, t], error[g][used])
            grad["u" + g] += h_before.T @ error[g]
            grad["b" + g] += error[g].sum(axis=0)
            back_h = back_h + error[g] @ p["u" + g].T
        back_cell = back_cell * gate["f"]
    return logs, grad


@dataclass(frozen=True)
class Model:
    initial: Callable[[Shape, int], Parameters]
    run: Callable
    reversed_input: bool


MLP = Model(mlp_parameters, mlp, False)
LSTM = Model(lstm_parameters, lstm, True)


# distributed evaluation -------------------------------------------------------------------

def prepare(encoded: DataFrame, shape: Shape, model: Model, normalize: bool = True) -> DataFrame:
    """``(idx, x array<int>, y array<double>)`` from encoded examples.

    ``x`` is the window the model reads, NULL where a name has ended. ``normalize`` scales
    the targets of an example with several labels to sum 1.
    """
    x = steps("chars", shape.max_len) if model.reversed_input else window_of("chars", shape.max_len)
    y = target("labels", shape.num_labels)
    if not normalize:
        y = F.transform(y, lambda v: (v > 0).cast("double"))
    return encoded.select("idx", x.alias("x"), y.alias("y"))


def _inputs(x: pd.Series, max_len: int) -> np.ndarray:
    lengths = x.map(len).to_numpy()
    flat = np.concatenate(x.to_list()).astype(np.float64)
    block = np.full((len(x), max_len), -1, dtype=np.int64)
    block[np.arange(max_len) < lengths[:, None]] = np.where(np.isnan(flat), -1, flat)
    return block


def _targets(y: pd.Series) -> np.ndarray:
    return np.stack(y.to_numpy())


def flatten(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflatten(flat: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for k in sorted(like):
        size = like[k].size
        out[k] = flat[at : at + size].reshape(like[k].shape)
        at += size
    return out


def partial_sums(examples: DataFrame, model: Model, shape: Shape, shared, with_gradient: bool) -> DataFrame:
    """``(chunk int, lane int, v array<double>)``: summed loss and rows, and the gradient, one set per partition."""
    run, max_len = model.run, shape.max_len

    def block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        loss, rows, summed = 0.0, 0, None
        for frame in frames:
            if not len(frame):
                continue
            x, y = _inputs(frame["x"], max_len), _targets(frame["y"])
            logs, grad = run(p, x, y if with_gradient else None)
            loss -= float((y * logs).sum())
            rows += len(x)
            if with_gradient:
                flat = flatten(grad)
                summed = flat if summed is None else summed + flat
        if not rows:
            return
        # On the way to Spark a NaN would become a missing value, which a sum passes over.
        if not np.isfinite(loss) or summed is not None and not np.isfinite(summed).all():
            raise FloatingPointError("loss or gradient is not finite; a smaller learning rate may help")
        totals = np.zeros((1, CHUNK))
        totals[0, :2] = loss, rows
        numbers, values = np.array([TOTALS]), totals
        if summed is not None:
            padded = np.pad(summed, (0, -len(summed) % CHUNK)).reshape(-1, CHUNK)
            touched = np.flatnonzero(padded.any(axis=1))
            numbers, values = np.concatenate([numbers, touched]), np.concatenate([totals, padded[touched]])
        lane = TaskContext.get().partitionId() % LANES
        yield pd.DataFrame({"chunk": numbers.astype(np.int32), "lane": np.int32(lane), "v": list(values)})

    return examples.select("x", "y").mapInPandas(block, "chunk int, lane int, v array<double>")


def add_up(chunks: DataFrame) -> DataFrame:
    """``(chunk, v)``: the sums of all rows of a chunk, by lanes first, so that no task adds a row of every partition."""
    total = F.expr("array(" + ", ".join(f"sum(v[{i}])" for i in range(CHUNK)) + ")").alias("v")
    return chunks.groupBy("chunk", "lane").agg(total).groupBy("chunk").agg(total)


def evaluate(
    examples: DataFrame, model: Model, shape: Shape, p: Parameters, with_gradient: bool
) -> tuple[float, int, Parameters | None]:
    """Mean loss, number of rows and mean gradient of a set of examples."""
    ship_package(examples.sparkSession)
    shared = examples.sparkSession.sparkContext.broadcast(p)
    sums = add_up(partial_sums(examples, model, shape, shared, with_gradient)).toPandas()
    shared.destroy()
    found = dict(zip(sums["chunk"], sums["v"]))
    if TOTALS not in found:
        return 0.0, 0, None
    loss, rows = found.pop(TOTALS)[:2]
    loss, rows = float(loss), int(rows)
    if not with_gradient:
        return loss / rows, rows, None
    size = sum(a.size for a in p.values())
    flat = np.zeros((-(-size // CHUNK), CHUNK))
    for chunk, values in found.items():
        flat[chunk] = values
    return loss / rows, rows, unflatten(flat.ravel()[:size] / rows, p)


def train(
    examples: DataFrame, valid: DataFrame, model: Model, shape: Shape, s: Settings, initial: Parameters | None = None
) -> Trained:
    """Train on ``prepare``-d examples and keep the parameters of the lowest validation loss.

    Training starts from ``initial`` if given, else from parameters drawn by the seed.

    Each epoch writes a fresh permutation with its batch as a column. A file holds a share of every batch, sorted by
    it, so a step reads the pages of its batch from all files. A step is a Spark job; ``steps`` fixes their number per epoch
    whatever the number of examples, else ``batch_size`` does.
    """
    spark = examples.sparkSession
    p = initial or model.initial(shape, s.seed)
    size = sum(a.nbytes for a in p.values())
    if size > s.max_parameter_bytes:
        raise ValueError(f"model has {size} bytes of parameters, more than the {s.max_parameter_bytes} allowed")
    examples = materialize(examples, "network-train")
    valid = materialize(valid, "network-valid")
    rows = examples.count()
    batch_size = max(1, -(-rows // s.steps)) if s.steps else s.batch_size
    batches_of = -(-rows // batch_size)
    losses, versions = scratch_path(spark, "network-losses"), scratch_path(spark, "network-versions")
    spark.createDataFrame([], _LOSSES).write.parquet(losses)
    for epoch in range(s.epochs):
        placed = batches.assign(examples, "idx", batch_size, s.seed, epoch).drop("rank")
        # Numbering has dealt rows out by hash, so every partition has a share of each batch.
        placed = materialize(placed.sortWithinPartitions("batch"), "network-epoch")
        course = []
        for batch in range(batches_of):
            loss, _, grad = evaluate(spread(placed.filter(F.col("batch") == batch), "idx"), model, shape, p, with_gradient=True)
            p = {k: p[k] - s.learning_rate * grad[k] for k in p}
            course.append(("train", epoch * batches_of + batch, float(loss)))
        discard(placed)
        loss, _, _ = evaluate(spread(valid, "idx"), model, shape, p, with_gradient=False)
        course.append(("valid", epoch, float(loss)))
        spark.createDataFrame(course, _LOSSES).coalesce(1).write.mode("append").parquet(losses)
        save_parameters(spark, p, f"{versions}/epoch={epoch}")
    discard(examples)
    discard(valid)
    table = spark.read.schema(_LOSSES).parquet(losses)
    best = best_epoch(table).collect()
    return Trained(load_parameters(spark, f"{versions}/epoch={best[0]['epoch']}") if best else p, table)


def predict(examples: DataFrame, model: Model, shape: Shape, p: Parameters) -> DataFrame:
    """``(idx, probs array<double>, loss double)`` for every ``prepare``-d example."""
    ship_package(examples.sparkSession)
    shared = examples.sparkSession.sparkContext.broadcast(p)
    run, max_len = model.run, shape.max_len

    def block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            logs, _ = run(shared.value, _inputs(frame["x"], max_len), None)
            loss = -(_targets(frame["y"]) * logs).sum(axis=1)
            yield pd.DataFrame({"idx": frame["idx"], "probs": list(np.exp(logs)), "loss": loss})

    return examples.select("idx", "x", "y").mapInPandas(block, "idx long, probs array<double>, loss double")


# saved models -----------------------------------------------------------------------------

def save_parameters(spark: SparkSession, p: Parameters, path: str, rows: int = 1 << 16) -> None:
    """``(name, shape array<int>, at long, values array<double>)`` as parquet, in pieces of ``rows`` values."""
    pieces = [
        (k, list(a.shape), at, a.ravel()[at : at + rows].tolist()) for k, a in p.items() for at in range(0, max(1, a.size), rows)
    ]
    spark.createDataFrame(pieces, "name string, shape array<int>, at long, values array<double>").write.mode("overwrite").parquet(path)


def load_parameters(spark: SparkSession, path: str) -> Parameters:
    found: dict[str, list] = {}
    for r in spark.read.parquet(path).collect():
        found.setdefault(r["name"], []).append((r["at"], r["shape"], r["values"]))
    return {k: np.concatenate([v for _, _, v in sorted(x)]).reshape(x[0][1]) for k, x in found.items()}
