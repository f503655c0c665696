import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusml.functions import text as T
from corpusml.functions import vectors as V


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first()["x"]


def many(spark, column, *named):
    """Evaluate on the rows of matrices and return a matrix."""
    names = [n for n, _ in named]
    data = [(i, *[list(map(float, m[i])) for _, m in named]) for i in range(len(named[0][1]))]
    schema = "i int, " + ", ".join(f"{n} array<double>" for n in names)
    return np.array([r["x"] for r in spark.createDataFrame(data, schema).orderBy("i").select(column.alias("x")).collect()])


def test_tokenizers(spark):
    text = "It's The_cat, é42 no\tNO"
    assert one(spark, T.words("t"), t=text) == ["It", "s", "The_cat", "42", "no", "NO"]
    assert one(spark, T.lower_words("t"), t=text) == ["it", "s", "the_cat", "42", "no", "no"]
    assert one(spark, T.content_words("t"), t=text) == ["the_cat", "42"]
    assert one(spark, T.whitespace_tokens("t"), t=text) == ["it's", "the_cat,", "é42", "no", "no"]
    for tokenizer in (T.words, T.content_words, T.whitespace_tokens):
        assert one(spark, tokenizer("t"), t="") == []


def test_lower_case_cannot_create_tokens(spark):
    # The Kelvin sign lower-cases to an ASCII k.
    assert one(spark, T.lower_words("t"), t="aKb") == ["a", "b"]


def test_stop_word_list():
    assert len(T.ENGLISH_STOP_WORDS) == len(set(T.ENGLISH_STOP_WORDS)) == 153


@pytest.mark.parametrize(
    "raw, decoded",
    [("C++_L%C3%A9on", "C++_Léon"), ("100%_x", "100%_x"), ("100%_C%C3%A9", "100%_Cé"), (" a%20b%09", "a b"), ("", "")],
)
def test_percent_decode(spark, raw, decoded):
    assert one(spark, T.percent_decode("t"), t=raw) == decoded


def test_hash_buckets(spark):
    import hashlib

    words = ["a", "the", "Zürich", ""]
    df = spark.createDataFrame([(w,) for w in words], ["w"])
    got = df.select(T.hash_bucket("w", 97, True).alias("p"), T.hash_bucket("w", 97).alias("x")).collect()
    assert [r["p"] for r in got] == [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 97 for w in words]
    assert all(0 <= r["x"] < 97 for r in got)


def test_characters(spark):
    assert one(spark, T.characters("t"), t="aé b") == ["a", "é", " ", "b"]
    assert one(spark, T.characters("t"), t="") == []


# Published unit values of the forward and backward functions.
X = np.array([[0.76677119, 0.12815245], [0.4007303, 0.77046941], [0.00574018, 0.71242641]])
Y = np.array([[-0.06655641, 0.10877971], [0.13663944, -0.12461873]])
Z = np.array([[0.0, 1.0], [0.0, 1.0], [1.0, 0.0]])
X_MUL_Y = np.array([[-0.03352286, 0.06743895], [0.07860534, -0.05242359], [0.0969635, -0.08815726]])
SOFTMAX_X = np.array([[0.65444116, 0.34555884], [0.40860406, 0.59139594], [0.33033148, 0.66966852]])
CROSS_ENTROPY = np.array([1.06259235, 0.52526954, 1.10765864])
RELU_DELTA = np.array([[0.66202207, 0.59765468], [0.01812402, 0.58537534]])
FUSED_DELTA = [5.69906247e-01, 8.66851385e-01, 2.79581480e-04]
FUSED = np.array([[3.72970104e-01, -3.72970104e-01], [3.54198998e-01, -3.54198998e-01], [-1.87226917e-04, 1.87226917e-04]])
A = np.array([[0.56868927, 0.88004577, 0.19957348], [0.15738243, 0.83758796, 0.08086533]])
B = np.array([[0.58373435, 0.30384789, 0.96120856], [0.78027835, 0.34217174, 0.6432494]])
DELTA = np.array([[0.66130212, 0.11137438, 0.64986955], [0.9184291, 0.43875828, 0.56809095]])
TANH_A = np.array([[0.51439602, 0.70644225, 0.19696538], [0.15609577, 0.68452937, 0.08068952]])
SIGMOID_A = np.array([[0.63846068, 0.70683171, 0.54972842], [0.5392646, 0.69795697, 0.52020532]])
A_HADAMARD_B = np.array([[0.33196346, 0.26740005, 0.19183174], [0.12280211, 0.28659893, 0.05201657]])
TANH_BACK = np.array([[0.48631942, 0.05579181, 0.62465763], [0.89605076, 0.23316473, 0.56439223]])
SIGMOID_BACK = np.array([[0.15264747, 0.02307907, 0.16086031], [0.22819133, 0.09249597, 0.14179081]])
HADAMARD_BACK = np.array([[0.38602476, 0.03384087, 0.62466017], [0.71663035, 0.15013069, 0.36542416]])


def close(got, wanted):
    np.testing.assert_allclose(got, wanted, rtol=1e-6, atol=1e-8)


def test_forward_values(spark):
    close(many(spark, V.relu("a"), ("a", Y)), np.maximum(Y, 0))
    close(many(spark, V.softmax("a"), ("a", X)), SOFTMAX_X)
    close(many(spark, V.cross_entropy("p", "t"), ("p", SOFTMAX_X), ("t", Z)), CROSS_ENTROPY)
    close(many(spark, V.tanh("a"), ("a", A)), TANH_A)
    close(many(spark, V.sigmoid("a"), ("a", A)), SIGMOID_A)
    close(many(spark, V.hadamard("a", "b"), ("a", A), ("b", B)), A_HADAMARD_B)
    close(many(spark, V.add("a", "b"), ("a", A), ("b", B)), A + B)
    close(many(spark, V.subtract("a", "b"), ("a", A), ("b", B)), A - B)
    close(many(spark, V.square("a"), ("a", A)), A * A)
    columns = F.array(*[F.array(*[F.lit(float(v)) for v in column]) for column in Y.T])
    close(many(spark, V.row_times_matrix("a", columns), ("a", X)), X_MUL_Y)


def test_backward_values(spark):
    close(many(spark, V.relu_grad("d", "a"), ("d", RELU_DELTA), ("a", Y)), RELU_DELTA * (Y > 0))
    close(many(spark, V.tanh_grad("d", "o"), ("d", DELTA), ("o", TANH_A)), TANH_BACK)
    close(many(spark, V.sigmoid_grad("d", "o"), ("d", DELTA), ("o", SIGMOID_A)), SIGMOID_BACK)
    close(many(spark, V.hadamard("d", "b"), ("d", DELTA), ("b", B)), HADAMARD_BACK)
    close(many(spark, V.square_grad("d", "a"), ("d", DELTA), ("a", A)), 2 * DELTA * A)
    delta = [[d] for d in FUSED_DELTA]
    got = many(spark, V.softmax_cross_entropy_grad(F.col("d")[0], "x", "z"), ("d", delta), ("x", X), ("z", Z))
    close(got, FUSED)


def test_softmax_of_large_logits(spark):
    close(many(spark, V.softmax("a"), ("a", [[1000.0, 1000.0]])), [[0.5, 0.5]])


def test_scalars(spark):
    assert one(spark, V.logistic("x", 20.0), x=1e6) == pytest.approx(math.exp(20) / (1 + math.exp(20)))
    assert one(spark, V.logistic("x", 20.0), x=-1e6) == pytest.approx(1 / (1 + math.exp(20)))
    assert one(spark, V.smoothed_log("c", "t", "v"), c=3.0, t=10.0, v=5.0) == pytest.approx(math.log(4) - math.log(15))
    assert one(spark, V.decay(F.col("r"), F.col("k")), r=0.1, k=3) == pytest.approx(0.9**3)
    for x in (1e-6, 0.1, 0.5, 1.0, 1.5, 2.0, 3.5, 7.999, 8.0, 8.001, 20.0, 171.5, 1e4 + 0.1, 1e9):
        assert one(spark, V.log_gamma("x"), x=x) == pytest.approx(math.lgamma(x), rel=1e-11, abs=1e-11)
    assert math.isnan(one(spark, V.log_gamma("x"), x=-1.5))
