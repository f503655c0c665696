import math

import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from corpusml.functions.text import words
from corpusml.plans import topics

DOCS = [(i, [(i * 7 + j * j) % 11 for j in range(i % 9)]) for i in range(40)]
S = topics.Settings(topics=3, alpha=0.5, beta=0.2, sweeps=2, clocks=3, seed=5)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, words array<int>").repartition(3)


def test_vocabulary_and_documents(spark):
    texts = spark.createDataFrame([(0, "b a b"), (1, "c")], "doc_id long, text string")
    tokens = texts.select("doc_id", F.posexplode(words("text")).alias("pos", "word"))
    vocab = topics.vocabulary(tokens)
    ids = {r["word"]: r["word_id"] for r in vocab.collect()}
    assert sorted(ids.values()) == [0, 1, 2]
    got = dict(rows(topics.word_id_documents(tokens, vocab)))
    assert got == {0: [ids["b"], ids["a"], ids["b"]], 1: [ids["c"]]}


def test_counts_and_likelihood_by_hand(spark):
    state = spark.createDataFrame(
        [(0, [0, 1, 1], [0, 1, 1]), (1, [2, 0, 1], [1, 0, 0])], "doc_id long, words array<int>, z array<int>"
    )
    wt, dt = topics.word_topic_counts(state), topics.document_topic_counts(state)
    assert rows(wt) == [(0, 0, 2), (1, 0, 1), (1, 1, 2), (2, 1, 1)]
    assert rows(topics.topic_counts(wt)) == [(0, 3), (1, 3)]
    assert rows(dt) == [(0, 0, 1), (0, 1, 2), (1, 0, 2), (1, 1, 1)]

    def dirichlet(counts, base):
        constant = len(counts) * math.lgamma(base) - math.lgamma(len(counts) * base)
        values = [n + base for n in counts]
        return sum(map(math.lgamma, values)) - math.lgamma(sum(values)) - constant

    s = topics.Settings(topics=2, alpha=0.3, beta=0.7)
    by_topic = dirichlet([2, 1, 0], s.beta) + dirichlet([0, 2, 1], s.beta)
    by_doc = dirichlet([1, 2], s.alpha) + dirichlet([2, 1], s.alpha)
    got = topics.log_likelihood(wt, dt, 3, s).first()
    assert got["topic_part"] == pytest.approx(by_topic)
    assert got["document_part"] == pytest.approx(by_doc)
    assert got["likelihood"] == pytest.approx(by_topic + by_doc)


def pairs_of(frozen, distinct):
    """Flat (sizes, topics, counts) of the words, as the sampler takes them."""
    found = [np.flatnonzero(frozen[w]) for d in distinct for w in d]
    counts = [frozen[w][k] for w, k in zip(np.concatenate(distinct), found)]
    return np.array([len(k) for k in found]), np.concatenate(found), np.concatenate(counts)


@pytest.mark.parametrize("num_topics, num_words, lengths", [(3, 6, (5, 0, 9, 1, 5)), (40, 9, (60, 200, 1, 33)), (1, 4, (7, 3))])
def test_resample_against_a_token_by_token_loop(num_topics, num_words, lengths):
    """The loop has a weight for every topic and term; rows of pairs grow wherever a word gets a new topic."""
    s = topics.Settings(topics=num_topics, alpha=0.5, beta=0.2)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, num_words, n).astype(np.int32) for n in lengths]
    z = [rng.integers(0, num_topics, len(d)).astype(np.int32) for d in docs]
    frozen = np.zeros((num_words, num_topics))
    for d, t in zip(docs, z):
        np.add.at(frozen, (d, t), 1.0)
    totals = frozen.sum(axis=0)
    keys = np.array([11, 3, 7, 2**59, 5])[: len(docs)]
    distinct = [np.unique(d) for d in docs]
    got = topics.resample(keys, docs, z, distinct, *pairs_of(frozen, distinct), totals, num_words, 4, s)

    for i, (words_of, old) in enumerate(zip(docs, z)):
        n_word, n_topic, topic = frozen.copy(), totals.copy(), old.copy()
        for j, w in enumerate(words_of):
            own = np.bincount(topic, minlength=num_topics).astype(float)
            for table in (own, n_word[w], n_topic):
                table[topic[j]] -= 1
            below = n_topic + s.beta * num_words
            plain = (own + s.alpha) * (n_word[w] + s.beta) / below
            terms = np.concatenate([(own + s.alpha) * n_word[w] / below, (own + s.alpha) * s.beta / below])
            assert np.allclose(terms.reshape(2, -1).sum(axis=0), plain)
            weight = np.cumsum(terms)
            u = topics._uniform(keys[i : i + 1].view(np.uint64), np.array([j]), 4)[0] * weight[-1]
            new = int((weight <= u).sum()) % num_topics
            topic[j] = new
            n_word[w][new] += 1
            n_topic[new] += 1
        assert got[i].tolist() == topic.tolist()


def test_a_document_does_not_depend_on_its_block():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 30, n).astype(np.int32) for n in rng.integers(0, 80, 25)]
    z = [rng.integers(0, 12, len(d)).astype(np.int32) for d in docs]
    frozen = np.zeros((30, 12))
    for d, t in zip(docs, z):
        np.add.at(frozen, (d, t), 1.0)
    s, keys = topics.Settings(topics=12), np.arange(25)

    def run(some):
        distinct = [np.unique(docs[i]) for i in some]
        return topics.resample(
            keys[some], [docs[i] for i in some], [z[i] for i in some], distinct, *pairs_of(frozen, distinct), frozen.sum(axis=0), 30, 0, s
        )

    together = run(np.arange(25))
    assert all(run(np.array([i]))[0].tolist() == together[i].tolist() for i in range(25) if len(docs[i]))


def test_uniform_numbers_look_uniform():
    u = np.concatenate([topics._uniform(np.arange(1000).astype(np.uint64), np.array([pos]), s) for pos in range(5) for s in range(2)])
    assert 0 <= u.min() and u.max() < 1
    assert abs(u.mean() - 0.5) < 0.01 and abs((u < 0.25).mean() - 0.25) < 0.02


def test_training_keeps_the_count_invariants(spark, docs):
    got = topics.train(docs, 11, S)
    tokens = sum(len(w) for _, w in DOCS)
    assert got.word_topics.agg(F.sum("n")).first()[0] == tokens
    assert topics.topic_counts(got.word_topics).agg(F.sum("n")).first()[0] == tokens
    assert rows(got.word_topics) == rows(topics.word_topic_counts(got.state))
    state = {r["doc_id"]: r for r in got.state.collect()}
    assert {i: r["words"] for i, r in state.items()} == dict(DOCS)
    assert all(len(r["z"]) == len(r["words"]) and all(0 <= t < 3 for t in r["z"]) for r in state.values())
    assert [h[0] for h in got.history] == [1, 2]


def test_result_does_not_depend_on_partitioning(spark, docs):
    base = rows(topics.train(docs, 11, S, likelihood=False).state)
    assert rows(topics.train(docs.repartition(1), 11, S, likelihood=False).state) == base


def test_counts_beyond_32_bits_keep_their_weight(spark):
    s = topics.Settings(topics=2, alpha=0.1, beta=0.1)
    state = spark.createDataFrame([(i, [0, 1], [0, 1]) for i in range(20)], "doc_id long, words array<int>, z array<int>")
    counts = spark.createDataFrame([(0, 0, 3_000_000_000), (0, 1, 1), (1, 0, 3_000_000_000), (1, 1, 1)], "word_id int, topic int, n long")
    # Totals weigh the topics alike, so the huge counts decide.
    balanced = counts.union(spark.createDataFrame([(2, 1, 6_000_000_000)], counts.schema))
    found = topics.sample(state, balanced, 3, 0, s)
    assert {t for r in found.collect() for t in r["z"]} == {0}


def test_words_outside_the_vocabulary_are_listed_by_id(spark):
    counts = spark.createDataFrame([(0, 0, 5), (1, 0, 9), (1, 1, 2)], "word_id int, topic int, n long")
    vocab = spark.createDataFrame([(0, "zero")], "word_id long, word string")
    assert rows(topics.topic_words(counts, vocab, 5)) == [(0, ["1", "zero"]), (1, ["1"])]


def test_sampling_finds_separate_topics(spark):
    """Two disjoint vocabularies must end up in different topics."""
    data = [(i, [(i % 2) * 5 + (i + j) % 5 for j in range(30)]) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, words array<int>")
    s = topics.Settings(topics=2, alpha=0.1, beta=0.1, sweeps=12)
    got = topics.train(df, 10, s)
    table = np.zeros((10, 2))
    for r in got.word_topics.collect():
        table[r["word_id"], r["topic"]] = r["n"]
    share = table.max(axis=1) / table.sum(axis=1)
    assert share.min() > 0.95
    assert set(table[:5].argmax(axis=1)) != set(table[5:].argmax(axis=1))
    assert got.history[-1][2] > got.history[0][2]


def test_topic_words(spark):
    wt = spark.createDataFrame([(0, 0, 5), (1, 0, 5), (2, 0, 9), (2, 1, 1)], "word_id int, topic int, n long")
    vocab = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "word_id long, word string")
    assert rows(topics.topic_words(wt, vocab, 2)) == [(0, ["two", "zero"]), (1, ["two"])]


def test_texts_are_numbered_like_their_tokens(spark):
    texts = spark.createDataFrame(
        [(0, "b a b"), (1, "c-É_d"), (2, None), (3, " ."), (4, "b c a"), (4, "x b"), (None, "a")], "doc_id long, text string"
    )
    tokens = texts.select("doc_id", F.posexplode(words("text")).alias("pos", "word"))
    vocab = topics.vocabulary(texts)
    assert rows(vocab) == rows(topics.vocabulary(tokens))
    got = topics.word_id_documents(texts, vocab)
    assert rows(got) == rows(topics.word_id_documents(tokens, vocab))
    # No row per token is made, let alone shuffled.
    assert "Generate" not in got._jdf.queryExecution().toString()


def test_a_block_fetches_a_word_once(spark, docs):
    state = topics.initial_topics(docs, 3, 5)
    counts = topics.word_topic_counts(state)
    plan = topics.sample(state, counts, 11, 0, S)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Generate" not in plan


def test_words_that_the_counts_lack_are_drawn_as_well(spark):
    state = spark.createDataFrame([(0, [0, 7, 9], [0, 1, 1]), (1, [], [])], "doc_id long, words array<int>, z array<int>")
    counts = spark.createDataFrame([(0, 0, 1)], "word_id int, topic int, n long")
    found = {r["doc_id"]: r for r in topics.sample(state, counts, 10, 0, topics.Settings(topics=2)).collect()}
    assert found[0]["words"] == [0, 7, 9] and set(found[0]["z"]) <= {0, 1} and found[1]["z"] == []
