"""Element-wise and reducing functions on ``array<double>`` columns, and scalar activations.

Every function is a higher-order SQL expression, so the work stays in the JVM next to the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# scalars ------------------------------------------------------------------------------

def logistic(x: Column | str, clamp: float | None = None) -> Column:
    """``1 / (1 + exp(-x))``, with ``x`` limited to ``[-clamp, clamp]`` if asked."""
    x = _col(x)
    if clamp is not None:
        x = F.least(F.lit(float(clamp)), F.greatest(F.lit(-float(clamp)), x))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def smoothed_log(count: Column | str, total: Column | str, size: Column | str) -> Column:
    """Log probability with add-one smoothing: ``log(count + 1) - log(total + size)``."""
    return F.log(_col(count) + 1.0) - F.log(_col(total) + _col(size))


def decay(rate: Column, elapsed: Column) -> Column:
    """Shrink factor ``(1 - rate) ** elapsed`` of a weight that was skipped ``elapsed`` times."""
    return F.pow(F.lit(1.0) - rate, elapsed)


#: Where the series for the gamma function begins.
_SHIFT = 8


def log_gamma(x: Column | str) -> Column:
    """Natural log of the gamma function of positive numbers, to some twelve digits.

    Arguments below ``_SHIFT`` are moved up by it with ``gamma(x + 1) = x * gamma(x)``; from there on Stirling's series
    is used. NaN for others, as there is no logarithm of a negative value.
    """
    x = _col(x).cast("double")
    small = x < _SHIFT
    product = x
    for k in range(1, _SHIFT):
        product = product * (x + k)
    y = F.when(small, x + _SHIFT).otherwise(x)
    inverse = F.lit(1.0) / y
    square = inverse * inverse
    # Bernoulli numbers over 2k (2k - 1).
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square * (1 / 1188)))))
    value = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    lowered = F.when(small, value - F.log(product)).otherwise(value)
    return F.when(x > 0, lowered).when(x.isNotNull(), F.lit(float("nan")))


# element-wise -------------------------------------------------------------------------

def relu(a: Column | str) -> Column:
    return F.transform(_col(a), lambda x: F.greatest(x, F.lit(0.0)))


def sigmoid(a: Column | str) -> Column:
    return F.transform(_col(a), lambda x: logistic(x))


def tanh(a: Column | str) -> Column:
    return F.transform(_col(a), F.tanh)


def square(a: Column | str) -> Column:
    return F.transform(_col(a), lambda x: x * x)


def add(a: Column | str, b: Column | str) -> Column:
    """Sum of two vectors; adding one bias vector to every row is the same expression."""
    return F.zip_with(_col(a), _col(b), lambda x, y: x + y)


def subtract(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x - y)


def hadamard(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x * y)


# reductions ---------------------------------------------------------------------------

def total(a: Column | str) -> Column:
    return F.aggregate(_col(a), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return total(hadamard(a, b))


def softmax(a: Column | str) -> Column:
    """Row softmax. The maximum is subtracted first, which leaves the result as it is."""
    a = _col(a)
    # The shifted exponentials are bound to a lambda variable so that they are computed once.
    exps = F.transform(a, lambda x: F.exp(x - F.array_max(a)))
    return F.transform(F.array(exps), lambda e: F.transform(e, lambda x: x / total(e)))[0]


def cross_entropy(p: Column | str, target: Column | str) -> Column:
    """``-sum(target * log(p))`` over one row.

    Terms with target 0 are 0; a target with probability 0 makes the loss infinite.
    """
    log = lambda q: F.when(q == 0, F.lit(float("-inf"))).otherwise(F.log(q))
    return -total(F.zip_with(_col(target), _col(p), lambda t, q: F.when(t == 0, F.lit(0.0)).otherwise(t * log(q))))


def row_times_matrix(a: Column | str, columns: Column | str) -> Column:
    """Row vector times a matrix given as the array of its columns."""
    a = _col(a)
    return F.transform(_col(columns), lambda column: dot(a, column))


# derivatives: each takes the incoming error first --------------------------------------

def relu_grad(delta: Column | str, x: Column | str) -> Column:
    return F.zip_with(_col(delta), _col(x), lambda d, v: F.when(v > 0, d).otherwise(F.lit(0.0)))


def tanh_grad(delta: Column | str, out: Column | str) -> Column:
    return F.zip_with(_col(delta), _col(out), lambda d, o: d * (1.0 - o * o))


def sigmoid_grad(delta: Column | str, out: Column | str) -> Column:
    return F.zip_with(_col(delta), _col(out), lambda d, o: d * o * (1.0 - o))


def square_grad(delta: Column | str, x: Column | str) -> Column:
    return F.zip_with(_col(delta), _col(x), lambda d, v: d * 2.0 * v)


def softmax_cross_entropy_grad(delta: Column | str, logits: Column | str, target: Column | str) -> Column:
    """Error of the fused pair: ``delta * (softmax(logits) - target)``, ``delta`` a scalar."""
    delta = _col(delta)
    return F.transform(subtract(softmax(logits), target), lambda g: delta * g)
