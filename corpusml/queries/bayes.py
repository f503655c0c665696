"""Naive Bayes counting and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusml.operators import groups
from corpusml.plans import evaluate, naive_bayes
from corpusml.queries.base import SQL_DOC_LABELS, Catalog, documents, places, sql_places, sql_stop_words, table

catalog = Catalog()

_CONTENT = f"word NOT IN ({sql_stop_words()})"

# Count tables as common table expressions: t (doc_id, word), wl (label, word, n), dl (label, n),
# tl (label, n), then the per-label prior and floor, and the term counts of every document.
_MODEL = rf"""
    t AS (SELECT * FROM (SELECT doc_id, lang, source, lower(unnest(regexp_extract_all(text, '\w+'))) AS word
                         FROM documents) WHERE {_CONTENT}),
    tf AS (SELECT doc_id, word, count(*) AS tf FROM t GROUP BY doc_id, word),
    dl AS (SELECT label, count(*) AS n FROM ({SQL_DOC_LABELS}) GROUP BY label),
    wl AS (SELECT label, word, count(*) AS n FROM (SELECT unnest(LABELS) AS label, word FROM t) GROUP BY label, word),
    tl AS (SELECT label, coalesce(sum(wl.n), 0) AS n FROM dl LEFT JOIN wl USING (label) GROUP BY label),
    s AS (SELECT (SELECT count(*) FROM dl) AS num_labels, (SELECT sum(n) FROM dl) AS label_total,
                 (SELECT count(DISTINCT word) FROM wl) AS vocabulary),
    lm AS (SELECT dl.label, ln(dl.n + 1.0) - ln(label_total + num_labels) AS prior, ln(tl.n + vocabulary) AS floor
           FROM dl JOIN tl USING (label), s)
"""
_FULL = _MODEL.replace("LABELS", "[lang, source]")
_FIRST = _MODEL.replace("LABELS", "[lang]")

_SCORES = f"""
    WITH {_FULL},
    known AS (SELECT doc_id, sum(tf) AS known FROM tf WHERE word IN (SELECT word FROM wl) GROUP BY doc_id),
    seen AS (SELECT doc_id, label, sum(tf * ln(n + 1.0)) AS s FROM tf JOIN wl USING (word) GROUP BY doc_id, label),
    scores AS (
        SELECT d.doc_id, lm.label, coalesce(s, 0) - coalesce(known, 0) * floor + prior AS score
        FROM documents d CROSS JOIN lm
        LEFT JOIN known USING (doc_id) LEFT JOIN seen ON seen.doc_id = d.doc_id AND seen.label = lm.label),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, label) AS place FROM scores)
"""


@catalog.add(f"SELECT label, count(*) AS n FROM ({SQL_DOC_LABELS}) GROUP BY label")
def nb_label_counts(spark, sf_dir):
    return naive_bayes.count(documents(spark, sf_dir)).labels


@catalog.add(f"WITH {_FULL} SELECT label, word, n FROM wl")
def nb_word_label_counts(spark, sf_dir):
    return naive_bayes.count(documents(spark, sf_dir)).words


@catalog.add(f"WITH {_FULL} SELECT label, CAST(n AS BIGINT) AS n FROM tl")
def nb_label_word_totals(spark, sf_dir):
    return naive_bayes.count(documents(spark, sf_dir)).label_words()


@catalog.add(f"WITH {_FULL} SELECT label, {sql_places('prior')} AS prior, {sql_places('floor')} AS floor FROM lm")
def nb_priors(spark, sf_dir):
    model = naive_bayes.label_model(naive_bayes.count(documents(spark, sf_dir)).stored())
    return model.select("label", places("prior").alias("prior"), places("floor").alias("floor"))


@catalog.add(f"{_SCORES} SELECT doc_id, label, {sql_places('score')} AS score FROM scores")
def nb_scores(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = naive_bayes.score(naive_bayes.count(docs).stored(), docs)
    flat = scored.select("doc_id", F.explode("scores").alias("s"))
    return flat.select("doc_id", "s.label", places("s.score").alias("score"))


@catalog.add(f"{_SCORES} SELECT doc_id, label, {sql_places('score')} AS score FROM best WHERE place = 1")
def nb_predict(spark, sf_dir):
    docs = documents(spark, sf_dir)
    chosen = naive_bayes.predict(naive_bayes.count(docs).stored(), docs)
    return chosen.withColumn("score", places("score"))


@catalog.add(f"""
    WITH {_FIRST},
    scores AS (
        SELECT doc_id, label, any_value(prior) + sum(tf * (ln(n + 1.0) - floor)) AS score
        FROM tf JOIN wl USING (word) JOIN lm USING (label) GROUP BY doc_id, label),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9), label) AS place FROM scores)
    SELECT doc_id, CASE WHEN score < 0 THEN label ELSE 'label' END AS label,
           {sql_places("least(score, 0)")} AS score
    FROM best WHERE place = 1
""")
def nb_predict_compat(spark, sf_dir):
    docs = documents(spark, sf_dir)
    chosen = naive_bayes.predict(naive_bayes.count(docs, compat=True).stored(), docs)
    return chosen.withColumn("score", places("score"))


@catalog.add(f"""
    {_SCORES}
    SELECT count(*) AS documents, CAST(sum(CASE WHEN label IN (lang, source) THEN 1 ELSE 0 END) AS BIGINT) AS correct,
           {sql_places("avg(CASE WHEN label IN (lang, source) THEN 1.0 ELSE 0.0 END)")} AS accuracy
    FROM best JOIN documents USING (doc_id) WHERE place = 1
""")
def nb_accuracy(spark, sf_dir):
    docs = documents(spark, sf_dir)
    chosen = naive_bayes.predict(naive_bayes.count(docs).stored(), docs)
    return evaluate.accuracy(chosen, docs).withColumn("accuracy", places("accuracy"))


@catalog.add(f"""
    WITH {_FULL}
    SELECT label, count(*) AS distinct_words, max(n) AS top_count FROM wl GROUP BY label
""")
def nb_label_vocabulary(spark, sf_dir):
    counts = naive_bayes.count(documents(spark, sf_dir)).words
    return groups.reduce_groups(counts, ["label"], distinct_words=F.count(F.lit(1)), top_count=F.max("n"))


# Part names as short documents with more labels than one block holds.
_MANY = rf"""
    docs AS (SELECT p_partkey AS doc_id, 'c' || (p_partkey % 1200) AS label, p_name AS text FROM part),
    t AS (SELECT * FROM (SELECT doc_id, label, lower(unnest(regexp_extract_all(text, '\w+'))) AS word FROM docs) WHERE {_CONTENT}),
    tf AS (SELECT doc_id, word, count(*) AS tf FROM t GROUP BY doc_id, word),
    dl AS (SELECT label, count(*) AS n FROM docs GROUP BY label),
    wl AS (SELECT label, word, count(*) AS n FROM t GROUP BY label, word),
    tl AS (SELECT label, coalesce(sum(wl.n), 0) AS n FROM dl LEFT JOIN wl USING (label) GROUP BY label),
    s AS (SELECT (SELECT count(*) FROM dl) AS num_labels, (SELECT sum(n) FROM dl) AS label_total, (SELECT count(DISTINCT word) FROM wl) AS vocabulary),
    lm AS (SELECT dl.label, ln(dl.n + 1.0) - ln(label_total + num_labels) AS prior, ln(tl.n + vocabulary) AS floor FROM dl JOIN tl USING (label), s)"""


@catalog.add(f"""
    WITH {_MANY},
    seen AS (SELECT doc_id, label, sum(tf * ln(n + 1.0)) AS s FROM tf JOIN wl USING (word) GROUP BY doc_id, label),
    known AS (SELECT doc_id, sum(tf) AS known FROM tf GROUP BY doc_id),
    scores AS (
        SELECT docs.doc_id, lm.label, coalesce(s, 0) - coalesce(known, 0) * floor + prior AS score
        FROM docs CROSS JOIN lm LEFT JOIN known USING (doc_id) LEFT JOIN seen ON seen.doc_id = docs.doc_id AND seen.label = lm.label),
    best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, label) AS place FROM scores)
    SELECT doc_id, label, {sql_places("score")} AS score FROM best WHERE place = 1
""")
def nb_many_labels(spark, sf_dir):
    """Over a thousand labels, in blocks."""
    label = F.concat(F.lit("c"), (F.col("p_partkey") % 1200).cast("string"))
    docs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.array(label).alias("labels"), F.col("p_name").alias("text"))
    chosen = naive_bayes.predict(naive_bayes.count(docs).stored(), docs)
    return chosen.withColumn("score", places("score"))
