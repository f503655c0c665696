import math
from collections import Counter

import pytest
from frames import rows

from corpusml.functions.text import ENGLISH_STOP_WORDS
from corpusml.plans import evaluate, naive_bayes

TRAIN = [
    (1, ["A"], "apple berry apple"),
    (2, ["B"], "berry cherry the"),
    (3, ["A", "B"], "apple"),
]
TEST = [(10, "apple apple berry"), (11, "unknown words"), (12, ""), (13, "the of"), (14, "Cherry kiwi")]


def frames(spark):
    train = spark.createDataFrame(TRAIN, "doc_id long, labels array<string>, text string")
    test = spark.createDataFrame(TEST, "doc_id long, text string")
    return train, test


def model(compat):
    counts, docs, totals = Counter(), Counter(), Counter()
    for _, labels, text in TRAIN:
        for place, label in enumerate(labels):
            docs[label] += 1
            totals[label] += 0
            for w in text.lower().split():
                if w not in ENGLISH_STOP_WORDS and (place == 0 or not compat):
                    counts[label, w] += 1
                    totals[label] += 1
    return counts, docs, totals, len({w for _, w in counts})


def by_hand(text, compat):
    """All label scores of one text, worked out word by word."""
    counts, docs, totals, size = model(compat)
    known = [w for w in text.lower().split() if any((y, w) in counts for y in docs)]
    out = {}
    for y in docs:
        used = [w for w in known if (y, w) in counts] if compat else known
        if compat and not used:
            continue
        out[y] = math.log(docs[y] + 1) - math.log(sum(docs.values()) + len(docs))
        out[y] += sum(math.log(counts[y, w] + 1) - math.log(totals[y] + size) for w in used)
    return out


@pytest.mark.parametrize("width", [64, 1])
@pytest.mark.parametrize("compat", [False, True])
def test_scores_against_hand_computation(spark, compat, width):
    train, test = frames(spark)
    scored = naive_bayes.score(naive_bayes.count(train, compat=compat), test, width)
    got = {r["doc_id"]: {s["label"]: s["score"] for s in r["scores"]} for r in scored.collect()}
    wanted = {i: by_hand(text, compat) for i, text in TEST}
    if compat:
        wanted = {i: s for i, s in wanted.items() if s}
        assert set(wanted) == {10, 14}
    assert got.keys() == wanted.keys()
    for i in wanted:
        assert got[i] == pytest.approx(wanted[i])


def test_default_takes_the_best_and_compat_the_worst_label(spark):
    train, test = frames(spark)
    best = {r["doc_id"]: r for r in naive_bayes.predict(naive_bayes.count(train), test).collect()}
    assert set(best) == {10, 11, 12, 13, 14}
    assert best[10]["label"] == "A" and best[14]["label"] == "B"
    # Without a known word only the prior counts; it is equal here, so the smaller label wins.
    assert best[12]["label"] == "A"
    old = {r["doc_id"]: r["label"] for r in naive_bayes.predict(naive_bayes.count(train, compat=True), test).collect()}
    scores = by_hand(TEST[0][1], True)
    assert old[10] == min(scores, key=scores.get)


def test_count_tables(spark):
    train, _ = frames(spark)
    trained = naive_bayes.count(train)
    assert rows(trained.labels) == [("A", 2), ("B", 2)]
    assert rows(trained.words) == [("A", "apple", 3), ("A", "berry", 1), ("B", "apple", 1), ("B", "berry", 1), ("B", "cherry", 1)]
    assert rows(trained.label_words()) == [("A", 4), ("B", 3)]
    assert tuple(trained.totals().first()) == (2, 4, 3)
    first = naive_bayes.count(train, compat=True)
    assert rows(first.label_words()) == [("A", 4), ("B", 2)]
    assert rows(first.labels) == [("A", 2), ("B", 2)]


def test_a_label_without_words_counts(spark):
    docs = spark.createDataFrame([(1, ["A"], "x"), (2, ["B"], "the")], "doc_id long, labels array<string>, text string")
    assert rows(naive_bayes.count(docs).label_words()) == [("A", 1), ("B", 0)]


def test_labels_may_hold_quotes(spark):
    docs = spark.createDataFrame([(1, ["it's \\"], "xx"), (2, ["B"], "zz")], "doc_id long, labels array<string>, text string")
    chosen = naive_bayes.predict(naive_bayes.count(docs), docs)
    assert {r["doc_id"]: r["label"] for r in chosen.collect()} == {1: "it's \\", 2: "B"}


def test_top_words(spark):
    counts = spark.createDataFrame([("A", f"w{i:02d}", i // 2) for i in range(40)], "label string, word string, n long")
    got = naive_bayes.top_words(counts, 10).orderBy("rank").collect()
    assert [r["word"] for r in got][:4] == ["w38", "w39", "w36", "w37"] and len(got) == 10


def test_a_hot_word_and_label(spark):
    """A third of all tokens is one word, and most documents have one label."""
    docs = [(i, ["big"] if i % 10 else ["small"], "hot " * 5 + " ".join(f"w{i}_{j}" for j in range(10))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, labels array<string>, text string").repartition(5)
    trained = naive_bayes.count(df)
    assert trained.words.filter("word = 'hot' and label = 'big'").first()["n"] == 54 * 5
    chosen = naive_bayes.predict(trained, df)
    assert chosen.count() == 60
    assert evaluate.accuracy(chosen, df).first()["documents"] == 60


def test_accuracy(spark):
    docs = spark.createDataFrame([(1, ["A", "B"]), (2, ["A"])], "doc_id long, labels array<string>")
    chosen = spark.createDataFrame([(1, "B"), (2, "B")], "doc_id long, label string")
    assert tuple(evaluate.accuracy(chosen, docs).first()) == (2, 1, 0.5)


def test_choosing_lists_near_scores_only_and_fetches_a_word_once_a_block(spark):
    docs = spark.createDataFrame([(i, [f"l{i % 7}"], f"w{i % 7} common w{i % 3}") for i in range(60)], "doc_id long, labels array<string>, text string")
    trained = naive_bayes.count(docs).stored()
    near = naive_bayes.score(trained, docs, 2, near=1e-8)
    assert "Generate" not in near._jdf.queryExecution().toString()
    full = {r["doc_id"]: {s["label"]: s["score"] for s in r["scores"]} for r in naive_bayes.score(trained, docs, 2).collect()}
    for r in near.collect():
        best = max(full[r["doc_id"]].values())
        assert {s["label"]: pytest.approx(s["score"]) for s in r["scores"]} == {k: v for k, v in full[r["doc_id"]].items() if v >= best - 1e-8}


def test_words_are_counted_in_tasks_before_they_meet_labels(spark):
    docs = spark.createDataFrame([(i, ["A", "A", None], "The x X_1 z-x") for i in range(50)] + [(50, None, "x"), (51, ["B"], None)], "doc_id long, labels array<string>, text string")
    assert naive_bayes.counted_words(docs.coalesce(1)).count() == 3
    assert {(r["label"], r["word"]): r["n"] for r in naive_bayes.count(docs).words.collect()} == {
        (label, word): n * (2 if label else 1) for label in ("A", None) for word, n in (("x", 100), ("x_1", 50), ("z", 50))
    }
