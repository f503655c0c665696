"""Tokenizers, hashing, counting and top words."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusml.functions import text as T
from corpusml.operators import groups, rows
from corpusml.plans import naive_bayes
from corpusml.queries.base import SQL_DOC_LABELS, Catalog, documents, sql_digest, sql_stop_words, table

catalog = Catalog()

BUCKETS = 1 << 16


@catalog.add(r"""
    SELECT doc_id, word, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\w+')) AS word FROM documents)
    GROUP BY doc_id, word
""")
def word_tokens(spark, sf_dir):
    tokens = rows.flat_map(documents(spark, sf_dir), T.words("text"), "word", "doc_id")
    return groups.count_groups(tokens, ["doc_id", "word"])


@catalog.add(rf"""
    SELECT word, count(*) AS n
    FROM (SELECT lower(unnest(regexp_extract_all(text, '\w+'))) AS word FROM documents)
    WHERE word NOT IN ({sql_stop_words()})
    GROUP BY word
""")
def stopword_tokens(spark, sf_dir):
    tokens = rows.flat_map(documents(spark, sf_dir), T.words("text"), "word")
    tokens = rows.map_rows(tokens, word=F.lower("word"))
    return groups.count_groups(rows.filter_rows(tokens, T.is_content_word(F.col("word"))), ["word"])


@catalog.add(r"""
    SELECT token, count(*) AS n
    FROM (SELECT unnest(regexp_extract_all(lower(text), '\S+')) AS token FROM conversations)
    GROUP BY token
""")
def whitespace_tokens(spark, sf_dir):
    tokens = rows.flat_map(table(spark, sf_dir, "conversations"), T.whitespace_tokens("text"), "token")
    return groups.count_groups(tokens, ["token"])


@catalog.add(rf"""
    SELECT doc_id, len(list_filter(list_transform(regexp_extract_all(text, '\w+'), lambda w: lower(w)),
                                   lambda w: w NOT IN ({sql_stop_words()}))) AS n_words
    FROM documents
""")
def list_length(spark, sf_dir):
    return rows.map_rows(
        documents(spark, sf_dir), "doc_id", n_words=F.size(T.content_words("text")).cast("long")
    )


@catalog.add(rf"""
    SELECT doc_id, feature, count(*) AS n
    FROM (SELECT doc_id, {sql_digest("lower(word)")} % {BUCKETS} AS feature
          FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\w+')) AS word FROM documents))
    GROUP BY doc_id, feature
""")
def hashed_features(spark, sf_dir):
    from corpusml.plans.logistic import hashed_words

    return hashed_words(documents(spark, sf_dir), BUCKETS, True)


@catalog.add(r"""
    SELECT doc_id, md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS decoded_md5 FROM documents
""")
def percent_decode(spark, sf_dir):
    encoded = F.replace(F.url_encode("text"), F.lit("+"), F.lit("%20"))
    return rows.map_rows(documents(spark, sf_dir), "doc_id", decoded_md5=F.md5(T.percent_decode(encoded)))


@catalog.add(rf"""
    WITH counts AS (
        SELECT label, word, count(*) AS n
        FROM (SELECT label, unnest(regexp_extract_all(text, '\w+')) AS word FROM ({SQL_DOC_LABELS}))
        GROUP BY label, word)
    SELECT label, word, n, CAST(rank AS INTEGER) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS rank FROM counts)
    WHERE rank <= 10
""")
def top_words_per_label(spark, sf_dir):
    model = naive_bayes.count(documents(spark, sf_dir), content_only=False)
    return naive_bayes.top_words(model.words, 10)
