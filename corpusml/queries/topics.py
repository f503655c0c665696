"""Topic modelling over the words of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusml.plans import topics
from corpusml.queries.base import Catalog, documents, places, sql_digest, sql_places

catalog = Catalog()

SETTINGS = topics.Settings(topics=10, alpha=0.1, beta=0.1, sweeps=2, clocks=2)

_WORDS = rf"""
    tok AS MATERIALIZED (
        SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos
        FROM (SELECT doc_id, regexp_extract_all(text, '\w+') AS w FROM documents)),
    vocab AS MATERIALIZED (
        SELECT word, row_number() OVER (ORDER BY {sql_digest("word")}, word) - 1 AS word_id
        FROM (SELECT DISTINCT word FROM tok))"""

_ASSIGNED = f"""{_WORDS},
    z AS MATERIALIZED (
        SELECT doc_id, word_id, word, {sql_digest("'0:' || doc_id || ':' || pos")} % {SETTINGS.topics} AS topic
        FROM tok JOIN vocab USING (word)),
    wt AS MATERIALIZED (SELECT word_id, word, topic, count(*) AS n FROM z GROUP BY ALL),
    dt AS MATERIALIZED (SELECT doc_id, topic, count(*) AS n FROM z GROUP BY ALL)"""


def _documents(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vocab = topics.vocabulary(docs)
    return topics.word_id_documents(docs, vocab), vocab


def _assigned(spark, sf_dir):
    docs, vocab = _documents(spark, sf_dir)
    return topics.initial_topics(docs, SETTINGS.topics, SETTINGS.seed), vocab


@catalog.add(f"WITH {_WORDS} SELECT word, word_id FROM vocab")
def word_dictionary(spark, sf_dir):
    return topics.vocabulary(documents(spark, sf_dir))


@catalog.add(f"""
    WITH {_WORDS}
    SELECT doc_id, string_agg(CAST(word_id AS VARCHAR), ',' ORDER BY pos) AS words
    FROM tok JOIN vocab USING (word) GROUP BY doc_id
""")
def doc_word_ids(spark, sf_dir):
    docs, _ = _documents(spark, sf_dir)
    return docs.select("doc_id", F.array_join(F.col("words").cast("array<string>"), ",").alias("words"))


@catalog.add(f"WITH {_WORDS} SELECT CAST(count(*) AS INTEGER) AS num_words FROM vocab")
def lda_vocabulary_size(spark, sf_dir):
    docs, _ = _documents(spark, sf_dir)
    return docs.agg((F.max(F.array_max("words")) + 1).alias("num_words"))


@catalog.add(f"WITH {_ASSIGNED} SELECT word_id, topic, n FROM wt")
def lda_init_counts(spark, sf_dir):
    state, _ = _assigned(spark, sf_dir)
    counts = topics.word_topic_counts(state)
    return counts.select(F.col("word_id").cast("long").alias("word_id"), F.col("topic").cast("long").alias("topic"), "n")


@catalog.add(f"WITH {_ASSIGNED} SELECT topic, CAST(sum(n) AS BIGINT) AS n FROM wt GROUP BY topic")
def lda_topic_counts(spark, sf_dir):
    state, _ = _assigned(spark, sf_dir)
    counts = topics.topic_counts(topics.word_topic_counts(state))
    return counts.select(F.col("topic").cast("long").alias("topic"), "n")


@catalog.add(f"WITH {_ASSIGNED} SELECT doc_id, topic, n FROM dt")
def lda_document_topic_counts(spark, sf_dir):
    state, _ = _assigned(spark, sf_dir)
    counts = topics.document_topic_counts(state)
    return counts.select("doc_id", F.col("topic").cast("long").alias("topic"), "n")


_A, _B, _K = SETTINGS.alpha, SETTINGS.beta, SETTINGS.topics


@catalog.add(f"""
    WITH {_ASSIGNED},
    v AS (SELECT count(*) AS v FROM vocab),
    parts AS (
        SELECT (SELECT sum(lgamma(n + {_B}) - lgamma({_B})) FROM wt)
             - (SELECT sum(lgamma(n + {_B} * v) - lgamma({_B} * v)) FROM (SELECT topic, sum(n) AS n FROM wt GROUP BY topic), v)
               AS topic_part,
               (SELECT sum(lgamma(n + {_A}) - lgamma({_A})) FROM dt)
             - (SELECT sum(lgamma(n + {_A} * {_K}) - lgamma({_A} * {_K})) FROM (SELECT doc_id, sum(n) AS n FROM dt GROUP BY doc_id))
               AS document_part)
    SELECT {sql_places("topic_part", 3)} AS topic_part, {sql_places("document_part", 3)} AS document_part,
           {sql_places("topic_part + document_part", 3)} AS likelihood FROM parts
""")
def lda_log_likelihood(spark, sf_dir):
    docs, _ = _documents(spark, sf_dir)
    docs = topics.materialize(docs, "query-docs")
    state = topics.initial_topics(docs, SETTINGS.topics, SETTINGS.seed)
    # Each is read by two sums.
    word_topics = topics.materialize(topics.word_topic_counts(state), "query-counts")
    doc_topics = topics.materialize(topics.document_topic_counts(state), "query-counts")
    parts = topics.log_likelihood(word_topics, doc_topics, topics.num_words(docs), SETTINGS)
    return parts.select(*[places(c, 3).alias(c) for c in parts.columns])


@catalog.add(f"""
    WITH {_ASSIGNED}
    SELECT topic, string_agg(word, ' ' ORDER BY rank) AS words
    FROM (SELECT topic, word, row_number() OVER (PARTITION BY topic ORDER BY n DESC, word_id) AS rank FROM wt)
    WHERE rank <= 10 GROUP BY topic
""")
def lda_topic_top_words(spark, sf_dir):
    state, vocab = _assigned(spark, sf_dir)
    listed = topics.topic_words(topics.word_topic_counts(state), vocab, 10)
    return listed.select(F.col("topic").cast("long").alias("topic"), F.array_join("words", " ").alias("words"))


# Sampling in SQL: one group of tables per sync, one fold over the positions of every document -----------

_WRAP, _STEP = "18446744073709551616::UHUGEINT", "11400714819323198485::UHUGEINT"


def _sql_mix(source: str, keep: str) -> str:
    """The splitmix64 finalizer of column ``x`` of a table."""
    first = f"SELECT {keep}, (xor(x, x >> 30) * 13787848793156543929::UHUGEINT) % {_WRAP} AS x FROM ({source})"
    second = f"SELECT {keep}, (xor(x, x >> 27) * 10723151780598845931::UHUGEINT) % {_WRAP} AS x FROM ({first})"
    return f"SELECT {keep}, xor(x, x >> 31) AS x FROM ({second})"


def _sql_draws(stream: int) -> str:
    """A uniform number for every position."""
    salted = _sql_mix(f"SELECT doc_id, (key::UHUGEINT + {stream} * {_STEP}) % {_WRAP} AS x FROM keys", "doc_id")
    placed = f"SELECT doc_id, pos, (x + (pos + 1)::UHUGEINT * {_STEP}) % {_WRAP} AS x FROM tok JOIN ({salted}) USING (doc_id)"
    return f"SELECT doc_id, pos, (x >> 11)::DOUBLE / 9007199254740992.0 AS u FROM ({_sql_mix(placed, 'doc_id, pos')})"


def _sql_sync(number: int, sweep: int, clock: int) -> str:
    """``z{number}`` from the assignments before it: part ``clock`` drawn again, the rest as it was."""
    b, a, k = number - 1, SETTINGS, SETTINGS.topics
    topics_of = f"range(0, {k})"
    # Occurrences of topic t among the positions of the same word so far, this one included.
    seen = ", ".join(f"count(*) FILTER (topic = {t}) OVER same" for t in range(k))
    # The word's term and the rest share a denominator; the draw runs through them in this order.
    own = f"list_transform({topics_of}, lambda t: a.own[t + 1] - (t = x.old)::INT)"
    below = f"list_transform({topics_of}, lambda t: totals[t + 1] + o[t + 1] - own0[t + 1] + {a.beta} * v)"
    word = f"list_transform({topics_of}, lambda t: x.base[t + 1] + len(list_filter(list_select(a.z, x.earlier), lambda y: y = t)))"
    terms = f"""list_concat(
        list_transform({topics_of}, lambda t: (o[t + 1] + {a.alpha}) * n[t + 1] / d[t + 1]),
        list_transform({topics_of}, lambda t: {a.beta} * (o[t + 1] + {a.alpha}) / d[t + 1]))"""
    sums = f"list_transform(range(1, {2 * k + 1}), lambda e: list_sum(w[1:e]))"
    drawn = f"len(list_filter(c, lambda y: y <= x.u * c[{2 * k}])) % {k}"
    after = f"""{{'own': list_transform({topics_of}, lambda t: o[t + 1] + (t = r)::INT), 'z': list_append(a.z, r::INT),
                 'base': []::BIGINT[], 'earlier': []::BIGINT[], 'old': 0, 'u': 0.0::DOUBLE}}"""
    body = after
    for name, value in (("r", drawn), ("c", sums), ("w", terms), ("n", word), ("d", below), ("o", own)):
        body = f"list_transform([{value}], lambda {name}: {body})[1]"
    return f"""
    n{number} AS MATERIALIZED (
        SELECT word_id, list(n ORDER BY t) AS frozen
        FROM (SELECT word_id, t, count(*) FILTER (topic = t) AS n FROM z{b}, range({k}) AS ts(t) GROUP BY ALL) GROUP BY word_id),
    s{number} AS MATERIALIZED (
        SELECT list(n ORDER BY t) AS totals, (SELECT count(*) FROM vocab) AS v
        FROM (SELECT t, count(*) FILTER (topic = t) AS n FROM z{b}, range({k}) AS ts(t) GROUP BY t)),
    u{number} AS MATERIALIZED ({_sql_draws(sweep)}),
    p{number} AS MATERIALIZED (
        SELECT doc_id, pos, word_id, topic, [{seen}] AS seen,
               coalesce(list(pos + 1) OVER (PARTITION BY doc_id, word_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS earlier
        FROM z{b} JOIN keys USING (doc_id) WHERE key % {a.clocks} = {clock}
        WINDOW same AS (PARTITION BY doc_id, word_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
    l{number} AS MATERIALIZED (
        SELECT doc_id, list_transform({topics_of}, lambda t: len(list_filter(list(topic), lambda y: y = t))) AS own0,
               list({{'own': []::BIGINT[], 'z': []::INT[], 'base': list_transform({topics_of}, lambda t: frozen[t + 1] - seen[t + 1]),
                      'earlier': earlier, 'old': topic::INT, 'u': u}} ORDER BY pos) AS items
        FROM p{number} JOIN n{number} USING (word_id) JOIN u{number} USING (doc_id, pos) GROUP BY doc_id),
    f{number} AS MATERIALIZED (
        SELECT doc_id, list_reduce(items, lambda a, x: {body},
                 {{'own': own0, 'z': []::INT[], 'base': []::BIGINT[], 'earlier': []::BIGINT[], 'old': 0, 'u': 0.0::DOUBLE}}).z AS z
        FROM l{number}, s{number}),
    z{number} AS MATERIALIZED (
        SELECT doc_id, pos, word_id, z[pos + 1] AS topic FROM p{number} JOIN f{number} USING (doc_id)
        UNION ALL SELECT z{b}.* FROM z{b} JOIN keys USING (doc_id) WHERE key % {a.clocks} <> {clock})"""


_SYNCS = [(sweep * SETTINGS.clocks + clock + 1, sweep, clock) for sweep in range(SETTINGS.sweeps) for clock in range(SETTINGS.clocks)]
_SAMPLED = f"""{_WORDS},
    keys AS MATERIALIZED (SELECT doc_id, {sql_digest("CAST(doc_id AS VARCHAR)", 15)} AS key FROM documents),
    z0 AS MATERIALIZED (
        SELECT doc_id, pos, word_id, CAST({sql_digest("'0:' || doc_id || ':' || pos")} % {SETTINGS.topics} AS INTEGER) AS topic
        FROM tok JOIN vocab USING (word)), {",".join(_sql_sync(*sync) for sync in _SYNCS)}"""


def _sql_likelihood(state: str) -> str:
    """Log likelihood of the assignments in a table."""
    return f"""
        (SELECT sum(lgamma(n + {_B}) - lgamma({_B})) FROM (SELECT count(*) AS n FROM {state} GROUP BY word_id, topic))
      - (SELECT sum(lgamma(n + {_B} * v) - lgamma({_B} * v)) FROM (SELECT count(*) AS n FROM {state} GROUP BY topic), (SELECT count(*) AS v FROM vocab))
      + (SELECT sum(lgamma(n + {_A}) - lgamma({_A})) FROM (SELECT count(*) AS n FROM {state} GROUP BY doc_id, topic))
      - (SELECT sum(lgamma(n + {_A} * {_K}) - lgamma({_A} * {_K})) FROM (SELECT count(*) AS n FROM {state} GROUP BY doc_id))"""


@catalog.add(f"WITH {_SAMPLED} SELECT CAST(word_id AS INTEGER) AS word_id, topic, count(*) AS n FROM z{len(_SYNCS)} GROUP BY ALL")
def lda_gibbs(spark, sf_dir):
    """Two sweeps of two syncs; the word-by-topic counts after them."""
    docs, _ = _documents(spark, sf_dir)
    docs = topics.materialize(docs, "query-docs")
    return topics.train(docs, topics.num_words(docs), SETTINGS, likelihood=False).word_topics


@catalog.add(f"WITH {_WORDS} SELECT word_id, count(*) AS n FROM tok JOIN vocab USING (word) GROUP BY word_id")
def lda_gibbs_totals(spark, sf_dir):
    """Sampling moves occurrences between topics: the sums of every word stay those of the corpus."""
    counts = lda_gibbs(spark, sf_dir)
    return counts.groupBy(F.col("word_id").cast("long").alias("word_id")).agg(F.sum("n").alias("n"))


@catalog.add(f"WITH {_SAMPLED} " + " UNION ALL ".join(
    f"SELECT {sweep + 1} AS iteration, {sql_places(_sql_likelihood(f'z{(sweep + 1) * SETTINGS.clocks}'), 3)} AS likelihood"
    for sweep in range(SETTINGS.sweeps)
))
def lda_likelihood_history(spark, sf_dir):
    """Log likelihood after each sweep."""
    docs, _ = _documents(spark, sf_dir)
    docs = topics.materialize(docs, "query-docs")
    trained = topics.train(docs, topics.num_words(docs), SETTINGS)
    history = [(sweep, likelihood) for sweep, _, likelihood in trained.history]
    out = spark.createDataFrame(history, "iteration int, likelihood double")
    return out.withColumn("likelihood", places("likelihood", 3))
