"""Sources and sinks: tables go out to files in the shared folder and come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusml.functions.text import words
from corpusml.operators import groups
from corpusml.plans import naive_bayes, topics
from corpusml.queries.base import SQL_DOC_LABELS, Catalog, documents, places, sql_digest, sql_places, table
from corpusml.sources import sinks, text
from corpusml.storage import materialize, reuse, scratch_path, store

catalog = Catalog()

PARTS = 7
TOPICS = 6


@catalog.add("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def store_and_reuse_view(spark, sf_dir):
    path = scratch_path(spark, "view")
    store(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"), path)
    return groups.count_groups(reuse(spark, path), ["l_returnflag", "l_linestatus"])


@catalog.add("""
    SELECT value, count(*) AS n
    FROM (SELECT 'order ' || o_orderkey || ' is ' || o_orderstatus AS value FROM orders) GROUP BY value
""")
def format_and_read_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    line = F.format_string("order %d is %s", "o_orderkey", "o_orderstatus")
    sinks.write_lines(table(spark, sf_dir, "orders"), line, path)
    return groups.count_groups(text.read_lines(spark, path), ["value"])


@catalog.add(r"""
    SELECT doc_id, lang || '|' || source AS labels, len(regexp_extract_all(text, '\w+')) AS n_words,
           md5(translate(text, chr(10) || chr(9) || chr(13), '   ')) AS text_md5
    FROM documents
""")
def labelled_documents_file(spark, sf_dir):
    path = scratch_path(spark, "labelled")
    sinks.write_labelled(documents(spark, sf_dir), path)
    return text.read_labelled(spark, path).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.array_join("labels", "|").alias("labels"),
        F.size(words("text")).cast("long").alias("n_words"), F.md5("text").alias("text_md5"),
    )


@catalog.add("""
    SELECT doc_id, md5(translate(text, chr(10) || chr(9) || chr(13), '   ')) AS text_md5 FROM documents
""")
def unlabelled_documents_file(spark, sf_dir):
    path = scratch_path(spark, "unlabelled")
    sinks.write_labelled(documents(spark, sf_dir), path)
    return text.read_unlabelled(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"))


@catalog.add("""
    SELECT row_number() OVER (ORDER BY url, page_id) - 1 AS idx, url || ' ' || page_id AS entity, 'page|web' AS labels FROM pages
""")
def entity_file(spark, sf_dir):
    path = scratch_path(spark, "entities")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.concat_ws(" ", "url", F.col("page_id").cast("string")).alias("name"))
    line = F.concat_ws("\t", F.replace(F.url_encode("name"), F.lit("+"), F.lit("%20")), F.lit("page,web"))
    sinks.write_lines(pages.orderBy("url", "page_id"), line, path)
    read = text.read_entities(spark, path)
    return read.withColumn("labels", F.array_join("labels", "|"))


@catalog.add(f"""
    SELECT page_id, 'a+b ' || url AS entity FROM pages
""")
def percent_encoded_entities(spark, sf_dir):
    path = scratch_path(spark, "encoded")
    name = F.concat(F.lit("a+b "), F.col("url"))
    encoded = F.replace(F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")), F.lit("%2B"), F.lit("+"))
    sinks.write_lines(table(spark, sf_dir, "pages"), F.concat_ws("\t", encoded, F.col("page_id").cast("string")), path)
    return text.read_entities(spark, path).select(F.col("labels")[0].cast("long").alias("page_id"), "entity")


@catalog.add(r"""
    SELECT doc_id, len(w) AS n, array_to_string(list_transform(w, lambda x: length(x)), ',') AS items
    FROM (SELECT doc_id, regexp_extract_all(text, '\w+') AS w FROM documents)
""")
def id_list_file(spark, sf_dir):
    """Ragged integer lines, here the id of a document and the lengths of its words."""
    path = scratch_path(spark, "ids")
    ids = F.concat(F.array("doc_id"), F.transform(words("text"), F.length)).cast("array<string>")
    sinks.write_lines(documents(spark, sf_dir), F.array_join(ids, ","), path)
    items = F.slice("words", F.lit(2), F.size("words") - 1)
    return text.read_id_lists(spark, path).select(
        F.col("words")[0].cast("long").alias("doc_id"), F.size(items).cast("long").alias("n"),
        F.array_join(items.cast("array<string>"), ",").alias("items"),
    )


@catalog.add(f"SELECT doc_id % {PARTS} AS part, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total FROM documents GROUP BY part")
def modulo_parts(spark, sf_dir):
    docs = text.distribute(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", PARTS)
    parts = text.with_part(docs, "doc_id", PARTS)
    return groups.reduce_groups(parts, ["part"], n=F.count(F.lit(1)), total=F.sum("n_chars"))


_WORD_COUNTS = rf"""
    SELECT label, word, count(*) AS n
    FROM (SELECT label, unnest(regexp_extract_all(text, '\w+')) AS word FROM ({SQL_DOC_LABELS})) GROUP BY label, word"""


@catalog.add(_WORD_COUNTS)
def counter_file(spark, sf_dir):
    path = scratch_path(spark, "counters")
    sinks.write_counters(naive_bayes.counters(documents(spark, sf_dir)), path)
    return text.read_counters(spark, path)


@catalog.add(f"""
    SELECT 'Y=' || label || ',W=' || word AS key, n FROM ({_WORD_COUNTS})
    UNION ALL SELECT 'Y=' || label || ',W=*', CAST(sum(n) AS BIGINT) FROM ({_WORD_COUNTS}) GROUP BY label
    UNION ALL SELECT 'Y=' || label, count(*) FROM ({SQL_DOC_LABELS}) GROUP BY label
    UNION ALL SELECT 'Y=*', count(*) FROM ({SQL_DOC_LABELS})
""")
def counter_keys(spark, sf_dir):
    """Counter lines summed by their text key, as written."""
    path = scratch_path(spark, "counters")
    sinks.write_counters(naive_bayes.counters(documents(spark, sf_dir)), path)
    pair = F.split("value", "\t")
    lines = text.read_lines(spark, path).select(pair[0].alias("key"), pair[1].cast("long").alias("n"))
    return groups.sum_groups(lines, ["key"], "n", "n")


@catalog.add(f"""
    SELECT label || ' ' || word || ' ' || n AS line
    FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS rank FROM ({_WORD_COUNTS}))
    WHERE rank <= 10
""")
def top_word_file(spark, sf_dir):
    path = scratch_path(spark, "top")
    counts = naive_bayes.count(documents(spark, sf_dir), content_only=False).words
    sinks.write_top_words(naive_bayes.top_words(counts, 10), path)
    return text.read_lines(spark, path).select(F.replace("value", F.lit("\t"), F.lit(" ")).alias("line"))


@catalog.add("""
    SELECT doc_id, 'en' || chr(9) || CASE WHEN lang = 'en' THEN '1.0' ELSE '0.0' END || ',other' || chr(9)
                        || CASE WHEN lang = 'en' THEN '0.0' ELSE '1.0' END AS line
    FROM documents
""")
def prediction_file(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    hit = (F.col("lang") == "en").cast("double")
    pairs = F.array(
        F.struct(F.lit("en").alias("label"), hit.alias("p")), F.struct(F.lit("other").alias("label"), (1 - hit).alias("p"))
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", pairs.alias("scores")).orderBy("doc_id")
    sinks.write_lines(docs, prediction_with_id(), path)
    return text.read_lines(spark, path).select(
        F.substring_index("value", "|", 1).cast("long").alias("doc_id"), F.substring_index("value", "|", -1).alias("line")
    )


def prediction_with_id():
    return F.concat_ws("|", F.col("doc_id").cast("string"), sinks.prediction_line("scores"))


def _topics(spark, sf_dir):
    """Words of the conversations as documents of word ids with a hashed topic each."""
    turns = table(spark, sf_dir, "conversations")
    doc_id = (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id")
    tokens = turns.select(doc_id, F.posexplode(words("text")).alias("pos", "word"))
    vocab = materialize(topics.vocabulary(tokens), "query-vocabulary")
    docs = topics.word_id_documents(tokens, vocab)
    return topics.word_topic_counts(topics.initial_topics(docs, TOPICS)), vocab


_SQL_TOPICS = rf"""
    tok AS MATERIALIZED (
        SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos
        FROM (SELECT conv_id * 1000 + turn AS doc_id, regexp_extract_all(text, '\w+') AS w FROM conversations)),
    vocab AS MATERIALIZED (
        SELECT word, row_number() OVER (ORDER BY {sql_digest("word")}, word) - 1 AS word_id FROM (SELECT DISTINCT word FROM tok)),
    wt AS MATERIALIZED (
        SELECT word_id, word, {sql_digest("'0:' || doc_id || ':' || pos")} % {TOPICS} AS topic, count(*) AS n
        FROM tok JOIN vocab USING (word) GROUP BY ALL)"""


@catalog.add(f"""
    WITH {_SQL_TOPICS}
    SELECT word, k AS topic, coalesce(n, 0) AS n
    FROM (SELECT word, word_id, unnest(range(0, {TOPICS})) AS k FROM vocab)
    LEFT JOIN (SELECT word_id, topic AS k, n FROM wt) USING (word_id, k)
""")
def word_topic_file(spark, sf_dir):
    """The word-by-topic table and its vocabulary, written and read back in long form."""
    counts, vocab = _topics(spark, sf_dir)
    path, vocab_path = scratch_path(spark, "word-topic"), scratch_path(spark, "vocabulary")
    sinks.write_word_topics(counts, TOPICS, path, vocab.count())
    sinks.write_lines(vocab.orderBy("word_id"), F.col("word"), vocab_path)
    read = text.read_word_topics(spark, path, TOPICS).join(text.read_vocabulary(spark, vocab_path), "word_id")
    return read.select("word", F.col("topic").cast("long").alias("topic"), F.col("n").cast("long").alias("n"))


@catalog.add(f"""
    WITH {_SQL_TOPICS}
    SELECT 2 * word_id + g AS word_id, k AS topic, CASE WHEN g = 0 THEN coalesce(n, 0) ELSE 0 END AS n
    FROM (SELECT word_id, unnest(range(0, {TOPICS})) AS k FROM vocab) CROSS JOIN (SELECT unnest([0, 1]) AS g)
    LEFT JOIN (SELECT word_id, topic AS k, n FROM wt) USING (word_id, k)
""")
def word_topic_gaps(spark, sf_dir):
    """The word-by-topic table of a vocabulary in which no document uses any odd id."""
    counts, vocab = _topics(spark, sf_dir)
    path = scratch_path(spark, "word-topic")
    spaced = counts.withColumn("word_id", F.col("word_id") * 2)
    sinks.write_word_topics(spaced, TOPICS, path, 2 * vocab.count())
    read = text.read_word_topics(spark, path, TOPICS)
    return read.select("word_id", F.col("topic").cast("long").alias("topic"), F.col("n").cast("long").alias("n"))


@catalog.add(f"""
    WITH {_SQL_TOPICS}
    SELECT topic || ',' || string_agg(word, ',' ORDER BY rank) AS line
    FROM (SELECT topic, word, row_number() OVER (PARTITION BY topic ORDER BY n DESC, word_id) AS rank FROM wt)
    WHERE rank <= 5 GROUP BY topic
""")
def topic_words_file(spark, sf_dir):
    counts, vocab = _topics(spark, sf_dir)
    path = scratch_path(spark, "topic-words")
    sinks.write_topic_words(topics.topic_words(counts, vocab, 5), path)
    return text.read_lines(spark, path).withColumnRenamed("value", "line")


@catalog.add("""
    SELECT row_number() OVER (ORDER BY m) || ',' || n || '.0,' || -n || '.0' AS line
    FROM (SELECT month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY m)
""")
def likelihood_file(spark, sf_dir):
    """A series of (iteration, seconds, likelihood), here the orders of each month."""
    path = scratch_path(spark, "likelihood")
    months = groups.count_groups(table(spark, sf_dir, "orders").select(F.month("o_orderdate").alias("iteration")), ["iteration"])
    n = F.col("n").cast("double")
    sinks.write_likelihood(months.select("iteration", n.alias("seconds"), (-n).alias("likelihood")), path)
    return text.read_lines(spark, path).withColumnRenamed("value", "line")


@catalog.add(f"""
    SELECT vec_id AS idx, pos - 1 AS pos, {sql_places("a[pos]")} AS v
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
""")
def probability_file(spark, sf_dir):
    path = scratch_path(spark, "probabilities")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), F.col("embedding").cast("array<double>").alias("probs"))
    sinks.write_probabilities(vectors, path)
    flat = reuse(spark, path).select("idx", F.posexplode("probs").alias("pos", "v"))
    return flat.select("idx", F.col("pos").cast("long").alias("pos"), places("v").alias("v"))
