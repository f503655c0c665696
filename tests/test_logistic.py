import hashlib
import math
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from corpusml.plans import evaluate, logistic
from corpusml.plans.batches import assign
from corpusml.queries import logistic as queries

DOCS = [
    (0, ["A"], "red red blue"),
    (1, ["B"], "blue green"),
    (2, ["A", "C"], "red green green green"),
    (3, ["C"], ""),
    (4, ["B"], "blue blue blue blue red"),
]
LABELS = ["A", "B", "C"]


def bucket(word, size):
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % size


def features(text, size):
    return [bucket(w.lower(), size) for w in re.findall(r"\w+", text)]


def sequential(order, s):
    """The rule one document at a time, on dense tables."""
    weight = {y: [0.0] * s.buckets for y in LABELS}
    last = {y: [0] * s.buckets for y in LABELS}
    k = 0
    rate = s.learning_rate
    for epoch in range(1, s.epochs + 1):
        rate = s.learning_rate / epoch**2
        for _, labels, text in order:
            k += 1
            words = features(text, s.buckets)
            for y in LABELS:
                score = max(-20.0, min(20.0, sum(weight[y][j] for j in words)))
                error = (1.0 if y in labels else 0.0) - 1 / (1 + math.exp(-score))
                if abs(error) < 1e-4:
                    continue
                for j in words:
                    if abs(weight[y][j]) >= s.decay_threshold:
                        weight[y][j] *= (1 - rate * s.decay_rate) ** (k - last[y][j])
                    weight[y][j] += rate * error
                    last[y][j] = k
    for y in LABELS:
        for j in range(s.buckets):
            if abs(weight[y][j]) >= s.decay_threshold:
                weight[y][j] *= (1 - rate * s.decay_rate) ** (k - last[y][j])
    return weight


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, labels array<string>, text string")


@pytest.mark.parametrize("threshold", [0.8, 0.0])
def test_batches_of_one_are_the_sequential_rule(spark, docs, threshold):
    s = logistic.Settings(
        buckets=8, learning_rate=0.9, decay_rate=0.3, epochs=2, batch_size=1,
        decay_threshold=threshold, seed=4, portable_hash=True,
    )
    placed = assign(docs, "doc_id", 1, s.seed).orderBy("batch").collect()
    order = [DOCS[r["doc_id"]] for r in placed]
    assert order != DOCS
    wanted = sequential(order, s)
    trained = logistic.train(docs, logistic.label_index(docs), s)
    got = {(r["label"], r["feature"]): r["w"] for r in logistic.weight_rows(trained).collect()}
    for y in LABELS:
        for j in range(s.buckets):
            assert got.get((y, j), 0.0) == pytest.approx(wanted[y][j], abs=1e-12)


def test_file_order_is_kept_without_shuffling(spark, docs):
    s = logistic.Settings(buckets=8, epochs=1, batch_size=1, portable_hash=True, shuffle=False)
    trained = logistic.weight_rows(logistic.train(docs, logistic.label_index(docs), s))
    got = {(r["label"], r["feature"]): r["w"] for r in trained.collect()}
    wanted = sequential(DOCS, s)
    for key, w in got.items():
        assert w == pytest.approx(wanted[key[0]][key[1]], abs=1e-12)


def index(spark, names):
    return logistic.Labels(spark.createDataFrame(list(zip(names, range(len(names)))), "label string, label_id long"), len(names))


def test_a_repeated_word_adds_twice_and_decays_once(spark):
    s = logistic.Settings(buckets=4, decay_rate=0.5, portable_hash=True)
    labels = index(spark, ["A"])
    weights = spark.createDataFrame([(bucket("red", 4), 0, [1.0], [3])], "feature long, block int, w array<double>, last array<long>")
    row = spark.createDataFrame([(1, ["A"], "red red")], "doc_id long, labels array<string>, text string")
    rows = row.withColumn("terms", logistic.hashed_terms(4, True)).join(logistic.label_ids(row, labels), "doc_id").select("doc_id", "ids", "terms")
    with_p = logistic.probabilities(logistic.by_block(rows, labels), logistic.dots(rows, weights, labels), labels)
    p = 1 / (1 + math.exp(-2.0))
    assert with_p.first()["p"] == [pytest.approx(p)]
    new = logistic.update(weights, logistic.gradient(with_p, labels), 5, 0.1, labels, s).first()
    assert new["w"][0] == pytest.approx(1.0 * (1 - 0.1 * 0.5) ** 2 + 2 * 0.1 * (1 - p))
    assert new["last"] == [5]


def test_a_small_residual_is_skipped(spark):
    with_p = spark.createDataFrame(
        [(1, 0, [1.0, 0.0], [0.99995, 0.5], [(0, 1)])], "doc_id long, block int, y array<double>, p array<double>, terms array<struct<term:long,n:long>>")
    assert logistic.gradient(with_p, index(spark, ["A", "B"])).first()["g"] == [None, -0.5]


def test_labels_in_several_blocks(spark, docs, monkeypatch):
    s = logistic.Settings(buckets=8, learning_rate=0.9, decay_rate=0.3, epochs=2, batch_size=2, portable_hash=True, parts=3)
    whole = {(r["label"], r["feature"]): r["w"] for r in logistic.weight_rows(logistic.train(docs, logistic.label_index(docs), s)).collect()}
    scores = {r["doc_id"]: r["scores"] for r in logistic.predict(docs, logistic.train(docs, logistic.label_index(docs), s), s).collect()}
    monkeypatch.setattr(logistic, "BLOCK", 2)
    labels = logistic.label_index(docs)
    assert (labels.width, labels.blocks) == (2, 2)
    model = logistic.train(docs, labels, s)
    cut = {(r["label"], r["feature"]): r["w"] for r in logistic.weight_rows(model).collect()}
    assert cut.keys() == whole.keys() and all(cut[k] == pytest.approx(whole[k], abs=1e-12) for k in cut)
    for r in logistic.predict(docs, model, s).collect():
        assert [x["label"] for x in r["scores"]] == LABELS
        assert [x["p"] for x in r["scores"]] == pytest.approx([x["p"] for x in scores[r["doc_id"]]])


def test_a_step_rewrites_the_pieces_it_touches(spark, docs):
    s = logistic.Settings(buckets=64, batch_size=1, portable_hash=True, parts=16)
    written = []
    replace = logistic.Pieces.replace
    logistic.Pieces.replace = lambda self, rows, numbers: (written.append(set(numbers)), replace(self, rows, numbers))[1]
    try:
        logistic.train(docs, logistic.label_index(docs), s)
    finally:
        logistic.Pieces.replace = replace
    words = [{bucket(w, 64) % 16 for w in text.split()} for _, _, text in DOCS if text]
    assert sorted(map(sorted, written)) == sorted(map(sorted, words))


def test_the_number_of_steps_is_a_setting(spark, docs):
    s = logistic.Settings(buckets=8, steps=2, portable_hash=True)
    batches = logistic.encoded(docs, logistic.label_index(docs), s).groupBy("batch").count().collect()
    assert sorted(r["count"] for r in batches) == [2, 3]


def test_documents_without_words_score_one_half(spark, docs):
    s = logistic.Settings(buckets=8, batch_size=2, portable_hash=True)
    scored = logistic.predict(docs, logistic.train(docs, logistic.label_index(docs), s), s)
    by_doc = {r["doc_id"]: {x["label"]: x["p"] for x in r["scores"]} for r in scored.collect()}
    assert set(by_doc) == {0, 1, 2, 3, 4}
    assert by_doc[3] == {"A": 0.5, "B": 0.5, "C": 0.5}
    assert scored.select(evaluate.top_label("scores").alias("y")).distinct().count() >= 1


def test_partitioning_does_not_change_the_weights(spark, docs):
    s = logistic.Settings(buckets=8, batch_size=2, epochs=2, portable_hash=True)
    a, b = (
        {(r["label"], r["feature"]): r["w"] for r in logistic.weight_rows(logistic.train(docs.repartition(n), logistic.label_index(docs), s)).collect()}
        for n in (1, 5)
    )
    assert a.keys() == b.keys()
    assert all(a[j] == pytest.approx(b[j], abs=1e-12) for j in a)


def test_labels_are_numbered_in_sorted_order(spark, docs):
    found = logistic.label_index(docs)
    assert [r["label"] for r in found.table.orderBy("label_id").collect()] == LABELS and found.count == 3
    many = spark.range(3000).selectExpr("id AS doc_id", "array(concat('c', id % 1500)) AS labels", "'' AS text")
    numbered = {r["label"]: r["label_id"] for r in logistic.label_index(many).table.collect()}
    assert numbered == {name: k for k, name in enumerate(sorted(f"c{k}" for k in range(1500)))}


def test_counts_inside_the_row(spark):
    from corpusml.functions.text import explode_terms, term_counts

    rows = spark.createDataFrame([(1, ["b", "a", "b", "b"]), (2, []), (3, None), (4, ["x"])], "id int, w array<string>")
    got = sorted(tuple(r) for r in explode_terms(rows, term_counts(rows["w"]), "id").collect())
    assert got == [(1, "a", 1), (1, "b", 3), (4, "x", 1)]


def test_a_gradient_in_blocks_is_that_of_the_rows(spark):
    """The same numbers as from rows per document and block of labels, without making these rows."""
    docs = spark.createDataFrame([(i, [f"l{i % 40:02d}"], f"w{i % 9} w{i % 5} x" if i % 7 else None) for i in range(80)], "doc_id long, labels array<string>, text string")
    labels = logistic.label_index(docs)
    rows_of = docs.withColumn("terms", logistic.hashed_terms(16, True)).join(logistic.label_ids(docs, labels), "doc_id").select("doc_id", "ids", "terms")
    first = logistic.gradient(logistic.probabilities(logistic.by_block(rows_of, labels), None, labels), labels)
    weights = first.select("feature", "block", F.transform("g", lambda x: F.coalesce(x * 9.0, F.lit(0.0))).alias("w"))
    for w in (None, weights):
        found = None if w is None else logistic.dots(rows_of, w, labels)
        want = {(r["feature"], r["block"]): r["g"] for r in logistic.gradient(logistic.probabilities(logistic.by_block(rows_of, labels), found, labels), labels).collect()}
        made = logistic.batch_gradient(rows_of, w, labels)
        got = {(r["feature"], r["block"]): r["g"] for r in made.collect()}
        assert got.keys() == want.keys()
        for k, g in want.items():
            assert [x is None for x in got[k]] == [x is None for x in g]
            assert [x for x in got[k] if x is not None] == pytest.approx([x for x in g if x is not None])
        assert "FlatMapCoGroupsInArrow" in made._jdf.queryExecution().toString()


def test_rows_that_share_an_id_share_their_sums(spark):
    docs = spark.createDataFrame([(1, ["A"], "x y"), (1, ["A"], "x"), (2, ["B"], "x x y"), (None, ["B"], "x"), (3, ["A"], None)], "doc_id long, labels array<string>, text string")
    s = logistic.Settings(buckets=64, portable_hash=True, steps=2)
    labels = logistic.label_index(docs)
    x = docs.limit(1).select(logistic.hash_bucket(F.lit("x"), 64, True)).first()[0]
    model = logistic.Model(spark.createDataFrame([(x, 0, [1.0, -1.0], [1, 1])], logistic._WEIGHTS), labels)
    got = sorted(((r["doc_id"] or 0, round(math.log(r["scores"][0]["p"] / (1 - r["scores"][0]["p"])))) for r in logistic.predict(docs, model, s).collect()))
    assert got == [(0, 0), (1, 2), (1, 2), (2, 2), (3, 0)]
    many = spark.createDataFrame([(i // 2 if i < 90 else None, [f"l{i}"], "x") for i in range(100)], docs.schema)
    scored = logistic.predict(many, logistic.train(many, logistic.label_index(many), s), s).collect()
    assert len(scored) == 46 and all(len(r["scores"]) == 100 for r in scored)


def test_only_the_own_score_meets_the_labels(spark, path):
    """The scores of every label would fill the disks; rows that share an id, and those without one, stay as they were."""
    rows = [(i, f"w{i % 7} w{i % 4} x" if i % 9 else None) for i in range(80)] + [(5, "w1"), (None, "w2 x")]
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(f"{path}/part.parquet")
    found = queries.lr_many_labels(spark, path)

    def below(node):
        return [node.children().apply(i) for i in range(node.children().size())]

    node = found._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        (node,) = below(node)
    assert "doc_id" in node.condition().toString()
    assert not any("array" in side.schema().simpleString() for side in below(node))

    docs = spark.createDataFrame([(i, None if i is None else [f"c{i}"], name) for i, name in rows], "doc_id long, labels array<string>, text string")
    docs = docs.withColumn("labels", F.coalesce("labels", F.array(F.lit(None).cast("string"))))
    s = replace(queries.SETTINGS, epochs=1)
    labels = logistic.label_index(docs)
    assert labels.blocks > 1
    scores = {r["doc_id"]: {x["label"]: x["p"] for x in r["scores"]} for r in logistic.predict(docs, logistic.train(docs, labels, s), s).collect()}
    want = sorted((i, f"c{i}", scores[i][f"c{i}"]) for i, _ in rows if i is not None)
    got = sorted(tuple(r) for r in found.collect())
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], abs=1e-6)
    assert len({r[2] for r in got}) > 5
