import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from corpusml.plans import batches, characters, networks

NAMES = [("ann lee", ["P"]), ("bo", ["P", "Q"]), ("rome", ["Q"]), ("a very long name", ["R"]), ("", ["R"])]


@pytest.fixture(scope="module")
def entities(spark):
    data = [(i, name, labels) for i, (name, labels) in enumerate(NAMES * 4)]
    return spark.createDataFrame(data, "idx long, entity string, labels array<string>")


@pytest.fixture(scope="module")
def encoded(entities):
    chars, labels = characters.vocabulary(entities), characters.label_dictionary(entities)
    return characters.encode(entities, chars, labels), networks.Shape(chars.count(), labels.count(), 6, 5)


def test_vocabulary_has_space_first_and_contiguous_ids(spark):
    df = spark.createDataFrame([(0, "b a!"), (1, "")], "idx long, entity string")
    assert rows(characters.vocabulary(df)) == [(" ", 0), ("!", 1), ("a", 2), ("b", 3)]
    no_space = spark.createDataFrame([(0, "b")], "idx long, entity string")
    assert rows(characters.vocabulary(no_space)) == [(" ", 0), ("b", 1)]


def test_labels_of_any_number_are_numbered_in_order(spark, entities):
    assert rows(characters.label_dictionary(entities)) == [("P", 0), ("Q", 1), ("R", 2)]
    many = spark.range(5000).selectExpr("id AS idx", "'x' AS entity", "array(concat('y', id % 2500), 'z') AS labels")
    names = sorted([f"y{k}" for k in range(2500)] + ["z"])
    assert {r["label"]: r["label_id"] for r in characters.label_dictionary(many).collect()} == {n: k for k, n in enumerate(names)}


def test_encoding_beyond_the_basic_plane(spark):
    df = spark.createDataFrame([(1, "a😀é", ["Q", "?", "P", "Q"]), (2, "", []), (3, "日 !", ["P"])], "idx long, entity string, labels array<string>")
    chars = characters.vocabulary(df.filter("idx != 3"))
    labels = characters.label_dictionary(df.filter("idx = 1").select(F.lit(["P", "Q"]).alias("labels")))
    got = {r["idx"]: (r["chars"], r["labels"]) for r in characters.encode(df, chars, labels).collect()}
    assert rows(chars) == [(" ", 0), ("a", 1), ("é", 2), ("😀", 3)]
    assert got == {1: ([1, 3, 2], [1, 0, 0, 1]), 2: ([], []), 3: ([None, 0, None], [0])}


def test_encoding(spark):
    train = spark.createDataFrame([(0, "ab", ["X", "Y"])], "idx long, entity string, labels array<string>")
    test = spark.createDataFrame([(0, "b a", ["Z", "Y"])], "idx long, entity string, labels array<string>")
    chars, labels = characters.vocabulary(train, test), characters.label_dictionary(train)
    got = characters.encode(test, chars, labels)
    assert tuple(got.first()) == (0, [2, 0, 1], [0, 1])
    assert got.select(characters.steps("chars", 5).alias("x")).first()["x"] == [None, None, 1, 0, 2]
    assert got.select(characters.steps("chars", 2).alias("x")).first()["x"] == [0, 2]
    assert got.select(characters.one_hot_positions("chars", 2, 3).alias("x")).first()["x"] == [2, 3]
    assert got.select(characters.multi_hot("labels", 3).alias("x")).first()["x"] == [1.0, 1.0, 0.0]
    assert got.select(characters.target("labels", 3).alias("x")).first()["x"] == [0.5, 0.5, 0.0]


def test_unseen_characters(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "entity string")

    assert rows(characters.unseen_characters(names("xyz"), names("x"), names("y"))) == [("z",)]


def test_batches_cover_every_row_and_the_last_is_short(spark):
    ids = spark.range(10).withColumnRenamed("id", "idx")
    sizes = batches.assign(ids, "idx", 4, seed=1).groupBy("batch").count()
    assert rows(sizes) == [(0, 4), (1, 4), (2, 2)]
    plain = batches.assign(ids, "idx", 4, shuffle=False)
    assert all(r["batch"] == r["idx"] // 4 for r in plain.collect())


@pytest.mark.parametrize("model", [networks.MLP, networks.LSTM])
def test_gradient_against_finite_differences(model):
    shape = networks.Shape(num_chars=4, num_labels=3, max_len=3, hidden=3)
    p = model.initial(shape, 1)
    x = np.array([[0, 1, -1], [3, 2, 1], [-1, -1, -1], [2, 2, -1]])
    y = np.array([[1.0, 0, 0], [0, 0.5, 0.5], [0, 0, 1], [0, 1, 0]])

    def loss(q):
        return float(-(y * model.run(q, x, None)[0]).sum())

    _, grad = model.run(p, x, y)
    assert grad.keys() == p.keys()
    for name in p:
        numeric = np.zeros_like(p[name])
        for at in np.ndindex(*p[name].shape):
            for sign in (1, -1):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += sign * 1e-6
                numeric[at] += sign * loss(q) / 2e-6
        np.testing.assert_allclose(grad[name], numeric, atol=1e-6)


@pytest.mark.parametrize("model", [networks.MLP, networks.LSTM])
def test_distributed_gradient_is_the_single_batch_gradient(encoded, model):
    data, shape = encoded
    examples = networks.prepare(data, shape, model)
    p = model.initial(shape, 0)
    local = examples.toPandas()
    x, y = networks._inputs(local["x"], shape.max_len), networks._targets(local["y"])
    _, whole = model.run(p, x, y)
    for parts in (1, 3, 40):
        loss, n, grad = networks.evaluate(examples.repartition(parts), model, shape, p, True)
        assert n == len(x) and loss > 0
        for name in p:
            np.testing.assert_allclose(grad[name], whole[name] / n, atol=1e-12)


@pytest.mark.parametrize("model", [networks.MLP, networks.LSTM])
def test_training_is_plain_sgd_and_keeps_the_best_epoch(spark, encoded, model):
    data, shape = encoded
    examples = networks.prepare(data, shape, model)
    s = networks.Settings(epochs=3, batch_size=8, learning_rate=0.3, seed=2)
    got = networks.train(examples, examples, model, shape, s)
    valid_loss = sorted(tuple(r) for r in got.series("valid").collect())
    assert sorted(r["step"] for r in got.series("train").collect()) == list(range(9)) and [e for e, _ in valid_loss] == [0, 1, 2]

    local = examples.toPandas().set_index("idx")
    p, best = model.initial(shape, s.seed), (np.inf, None)
    for epoch in range(3):
        order = batches.assign(examples.select("idx"), "idx", 8, s.seed, epoch).toPandas()
        for _, batch in order.groupby("batch"):
            part = local.loc[batch["idx"]]
            x, y = networks._inputs(part["x"], shape.max_len), networks._targets(part["y"])
            _, grad = model.run(p, x, y)
            p = {k: p[k] - s.learning_rate * grad[k] / len(x) for k in p}
        x, y = networks._inputs(local["x"], shape.max_len), networks._targets(local["y"])
        loss = float(-(y * model.run(p, x, None)[0]).sum()) / len(x)
        assert valid_loss[epoch][1] == pytest.approx(loss)
        if loss < best[0]:
            best = (loss, p)
    for name in p:
        np.testing.assert_allclose(got.parameters[name], best[1][name], atol=1e-9)


def test_prediction_and_saved_parameters(spark, encoded, path):
    data, shape = encoded
    examples = networks.prepare(data, shape, networks.MLP)
    p = networks.MLP.initial(shape, 3)
    networks.save_parameters(spark, p, path)
    again = networks.load_parameters(spark, path)
    got = networks.predict(examples, networks.MLP, shape, again).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(20))
    assert all(sum(r["probs"]) == pytest.approx(1.0) and r["loss"] > 0 for r in got)
    networks.save_parameters(spark, p, path, rows=7)
    again = networks.load_parameters(spark, path)
    assert again.keys() == p.keys() and all(np.array_equal(again[k], p[k]) for k in p)


def test_multi_hot_targets_are_an_option(spark, encoded):
    data, shape = encoded
    both = networks.prepare(data, shape, networks.MLP, normalize=False).filter(F.col("idx") == 1).first()
    assert both["y"] == [1.0, 1.0, 0.0]


def test_parameter_size_is_checked(encoded):
    data, shape = encoded
    examples = networks.prepare(data, shape, networks.MLP)
    with pytest.raises(ValueError):
        networks.train(examples, examples, networks.MLP, shape, networks.Settings(max_parameter_bytes=10))


def test_underflowing_probabilities_keep_their_loss(spark):
    shape = networks.Shape(2, 2, 1, 1)
    p = {"w1": np.array([[1.0], [0.0]]), "b1": np.zeros(1), "w2": np.array([[2000.0, 0.0]]), "b2": np.array([1.0, 1.0])}
    rows_ = [(0, [0], [0.0, 1.0]), (1, [1], [1.0, 0.0])]
    losses = []
    for parts in (1, 2):
        df = spark.createDataFrame(rows_, "idx long, x array<int>, y array<double>").repartitionByRange(parts, "idx")
        losses.append(networks.evaluate(df, networks.MLP, shape, p, with_gradient=False)[0])
        assert all(np.isfinite(r["loss"]) for r in networks.predict(df, networks.MLP, shape, p).collect())
    assert losses[0] == losses[1] == pytest.approx((2000 + np.log(2)) / 2)
    broken = {**p, "w1": np.array([[np.nan], [0.0]])}
    with pytest.raises(Exception, match="not finite"):
        networks.evaluate(df, networks.MLP, shape, broken, with_gradient=True)


def test_the_best_epoch_is_the_first_of_the_lowest(spark):
    def best(valid):
        losses = [("train", 0, 0.001)] + [("valid", e, x) for e, x in enumerate(valid)]
        return rows(networks.best_epoch(spark.createDataFrame(losses, "kind string, step int, loss double")))

    assert best([3.0, 1.5, 1.5, 2.0]) == [(1, 1.5)]
    assert best([0.5, 0.7, 9.0]) == [(0, 0.5)]
    assert best([]) == []


def test_training_keeps_an_earlier_epoch(spark, encoded):
    data, shape = encoded
    examples = networks.prepare(data, shape, networks.MLP)
    # A rate that makes later epochs worse.
    got = networks.train(examples, examples, networks.MLP, shape, networks.Settings(epochs=4, steps=2, learning_rate=4.0, seed=2))
    valid = {r["step"]: r["loss"] for r in got.series("valid").collect()}
    kept = networks.evaluate(examples, networks.MLP, shape, got.parameters, False)[0]
    assert len(valid) == 4 and kept == pytest.approx(min(valid.values())) and got.series("train").count() == 8


def test_gradients_are_added_in_two_levels(spark):
    chunks = [(c, lane, [float(c + lane + i) for i in range(networks.CHUNK)]) for c in (-1, 0, 5) for lane in (0, 0, 3)]
    got = {r["chunk"]: r["v"] for r in networks.add_up(spark.createDataFrame(chunks, "chunk int, lane int, v array<double>")).collect()}
    assert got == {c: [3.0 * (c + i) + 3 for i in range(networks.CHUNK)] for c in (-1, 0, 5)}
