"""The relational operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusml.functions.text import words
from corpusml.operators import groups, joins, ranking, rows, sets
from corpusml.plans import naive_bayes
from corpusml.sources.sinks import show_rows as show
from corpusml.sources.text import take_part as part_of
from corpusml.queries.base import SQL_DOC_LABELS, Catalog, documents, places, table

catalog = Catalog()


# rows ---------------------------------------------------------------------------------------

@catalog.add("""
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) + 0.0 AS net
    FROM lineitem
""")
def map_rows(spark, sf_dir):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.map_rows(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", net=places(net))


@catalog.add("SELECT doc_id, n_chars FROM documents")
def project_fields(spark, sf_dir):
    return rows.map_rows(table(spark, sf_dir, "documents"), "doc_id", "n_chars")


@catalog.add("""
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'N'
""")
def filter_rows(spark, sf_dir):
    kept = rows.filter_rows(
        table(spark, sf_dir, "lineitem"), (F.col("l_quantity") > 25) & (F.col("l_returnflag") == "N")
    )
    return rows.map_rows(kept, "l_orderkey", "l_linenumber", "l_quantity")


@catalog.add("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def flat_map(spark, sf_dir):
    # Written as a chain: each step takes the view before it.
    return (
        table(spark, sf_dir, "part")
        .transform(rows.map_rows, "p_partkey", parts=F.split("p_name", " "))
        .transform(rows.flat_map, F.col("parts"), "word", "p_partkey")
    )


@catalog.add("""
    SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders
""")
def map_partitions(spark, sf_dir):
    def block(frames):
        for frame in frames:
            frame["priority"] = frame["o_orderpriority"].str[0].astype("int64")
            frame["cents"] = (frame["o_totalprice"] * 100).round().astype("int64")
            yield frame[["o_orderkey", "priority", "cents"]]

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rows.map_partitions(orders, block, "o_orderkey long, priority long, cents long")


@catalog.add("SELECT doc_id, unnest([lang, source]) AS label FROM documents")
def label_rows(spark, sf_dir):
    return rows.flat_map(documents(spark, sf_dir), F.col("labels"), "label", "doc_id")


# joins --------------------------------------------------------------------------------------

@catalog.add("""
    SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_inner(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = joins.join(orders, customers, [(orders.o_custkey, customers.c_custkey)])
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@catalog.add("""
    SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def join_left(spark, sf_dir):
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = joins.join(docs, marks, [(docs.doc_id, marks.doc_id)], left_outer=True)
    return joined.select(docs.doc_id, "lang", "quality", "toxic")


@catalog.add("""
    SELECT d.doc_id, n_chars, quality FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id
""")
def join_right(spark, sf_dir):
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = joins.join(marks, docs, [(marks.doc_id, docs.doc_id)], right_outer=True)
    return joined.select(docs.doc_id, "n_chars", "quality")


@catalog.add("""
    SELECT conv_id, turn, doc_id, quality FROM conversations FULL JOIN labels ON conv_id = doc_id
""")
def join_full(spark, sf_dir):
    turns, marks = table(spark, sf_dir, "conversations"), table(spark, sf_dir, "labels")
    joined = joins.join(turns, marks, [(turns.conv_id, marks.doc_id)], left_outer=True, right_outer=True)
    return joined.select("conv_id", "turn", "doc_id", "quality")


@catalog.add("""
    SELECT nationkey, n_name, customers, suppliers
    FROM (SELECT n_nationkey AS nationkey, n_name FROM nation)
    JOIN (SELECT c_nationkey AS nationkey, count(*) AS customers FROM customer GROUP BY 1) USING (nationkey)
    JOIN (SELECT s_nationkey AS nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) USING (nationkey)
""")
def join_three_way(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return joins.join_all(
        [
            nations,
            groups.count_groups(customers, ["nationkey"], "customers"),
            groups.count_groups(suppliers, ["nationkey"], "suppliers"),
        ],
        ["nationkey"],
    )


@catalog.add("""
    WITH a AS (SELECT nullif(lang, 'en') AS ka, count(*) AS na FROM documents GROUP BY 1),
         b AS (SELECT nullif(lang, 'de') AS kb, count(*) AS nb FROM documents GROUP BY 1)
    SELECT ka, kb, na, nb FROM a JOIN b ON ka IS NOT DISTINCT FROM kb
""")
def join_null_safe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    a = groups.count_groups(docs.select(F.nullif("lang", F.lit("en")).alias("ka")), ["ka"], "na")
    b = groups.count_groups(docs.select(F.nullif("lang", F.lit("de")).alias("kb")), ["kb"], "nb")
    return joins.join(a, b, [(a.ka, b.kb)], null_safe=True)


@catalog.add("""
    SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def join_chained(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return table(spark, sf_dir, "lineitem").transform(
        lambda items: joins.join(items, parts, [(items.l_partkey, parts.p_partkey)])
    ).select("l_orderkey", "l_linenumber", "p_name")


@catalog.add("""
    SELECT d.doc_id, coalesce(quality, -1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def lookup_default(spark, sf_dir):
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return joins.lookup(docs.select("doc_id"), marks, "doc_id", "quality", F.lit(-1))


@catalog.add("""
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN -1 ELSE nullif(toxic, 0) END AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def lookup_null_value(spark, sf_dir):
    """A missing value of the side table stays missing; only a missing key gets the default."""
    docs = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels").select("doc_id", F.nullif("toxic", F.lit(0)).alias("toxic"))
    return joins.lookup(docs.select("doc_id"), marks, "doc_id", "toxic", F.lit(-1))


@catalog.add("SELECT n_nationkey, doc_id, quality FROM nation FULL JOIN labels ON n_nationkey = quality")
def join_full_hot_right(spark, sf_dir):
    """A full join whose right side has two keys only."""
    nations, marks = table(spark, sf_dir, "nation"), table(spark, sf_dir, "labels")
    joined = joins.join(nations, marks, [(nations.n_nationkey, marks.quality)], left_outer=True, right_outer=True)
    return joined.select("n_nationkey", "doc_id", "quality")


@catalog.add("SELECT doc_id, quality, n_nationkey FROM labels FULL JOIN nation ON quality = n_nationkey")
def join_full_hot_left(spark, sf_dir):
    nations, marks = table(spark, sf_dir, "nation"), table(spark, sf_dir, "labels")
    joined = joins.join(marks, nations, [(marks.quality, nations.n_nationkey)], left_outer=True, right_outer=True)
    return joined.select("doc_id", "quality", "n_nationkey")


# side tables --------------------------------------------------------------------------------

@catalog.add("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def augment_side_table(spark, sf_dir):
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    paired = rows.augment(customers, nations, lambda v: rows.as_map(v, "n_nationkey", "n_name"), "names")
    return paired.select("c_custkey", F.try_element_at("names", F.col("c_nationkey")).alias("n_name"))


@catalog.add("""
    SELECT s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
""")
def augment_two_sides(spark, sf_dir):
    def region_of_nation(nations, regions):
        named = joins.join(nations, regions, [(nations.n_regionkey, regions.r_regionkey)])
        return rows.as_map(named, "n_nationkey", "r_name")

    sides = [table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")]
    paired = rows.augment(table(spark, sf_dir, "supplier"), sides, region_of_nation, "regions")
    return paired.select("s_suppkey", F.try_element_at("regions", F.col("s_nationkey")).alias("r_name"))


@catalog.add(rf"""
    SELECT (SELECT count(DISTINCT label) FROM ({SQL_DOC_LABELS})) AS num_labels,
           (SELECT count(*) FROM ({SQL_DOC_LABELS})) AS label_total,
           (SELECT count(DISTINCT word) FROM (SELECT unnest(regexp_extract_all(text, '\w+')) AS word FROM documents))
               AS vocabulary
""")
def gather_scalars(spark, sf_dir):
    totals = naive_bayes.count(documents(spark, sf_dir), content_only=False).totals()
    return totals.select("num_labels", F.col("label_total").cast("long").alias("label_total"), "vocabulary")


# groups -------------------------------------------------------------------------------------

@catalog.add("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(spark, sf_dir):
    return groups.count_groups(table(spark, sf_dir, "events"), ["event_type"])


@catalog.add("SELECT l_partkey, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem GROUP BY l_partkey")
def group_sum(spark, sf_dir):
    return groups.sum_groups(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_quantity")


@catalog.add(r"""
    WITH counts AS (
        SELECT word, label, count(*) AS n
        FROM (SELECT unnest([lang, source]) AS label, word
              FROM (SELECT lang, source, unnest(regexp_extract_all(text, '\w+')) AS word FROM documents))
        GROUP BY word, label)
    SELECT word, string_agg(label || ':' || n, ' ' ORDER BY label) AS entries FROM counts GROUP BY word
""")
def group_list(spark, sf_dir):
    lists = naive_bayes.word_lists(naive_bayes.count(documents(spark, sf_dir), content_only=False))
    entry = F.transform("entries", lambda e: F.concat_ws(":", e["label"], e["n"].cast("string")))
    return lists.select("word", F.array_join(entry, " ").alias("entries"))


@catalog.add("""
    SELECT o_custkey, CAST(0 AS BIGINT) AS piece, CAST(1 AS BIGINT) AS pieces,
           string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS items
    FROM orders GROUP BY o_custkey
""")
def group_rows(spark, sf_dir):
    grouped = groups.group_rows(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderkey"))
    return grouped.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@catalog.add("SELECT l_partkey, bit_xor(l_orderkey) AS result FROM lineitem GROUP BY l_partkey")
def group_fold(spark, sf_dir):
    def xor(a, b):
        return a.bitwiseXOR(b)

    items = table(spark, sf_dir, "lineitem")
    return groups.fold_groups(items, ["l_partkey"], F.col("l_orderkey"), F.lit(0).cast("long"), xor, xor)


@catalog.add("""
    SELECT o_custkey, CAST(0 AS BIGINT) AS piece, CAST(1 AS BIGINT) AS pieces, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT o_custkey, unnest([o_orderstatus, o_orderpriority]) AS item FROM orders)
    GROUP BY o_custkey
""")
def group_list_concat(spark, sf_dir):
    pairs = table(spark, sf_dir, "orders").select("o_custkey", F.array("o_orderstatus", "o_orderpriority").alias("pair"))
    lists = groups.concat_lists(pairs, ["o_custkey"], "pair")
    return lists.withColumn("items", F.array_join("items", ","))


@catalog.add("""
    SELECT o_custkey, CAST(0 AS BIGINT) AS piece, CAST(1 AS BIGINT) AS pieces,
           coalesce(string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (WHERE o_orderstatus = 'P'), '') AS items
    FROM orders GROUP BY o_custkey
""")
def list_concat_empty(spark, sf_dir):
    """Lists of the orders in process; most customers have none and keep an empty list."""
    listed = F.when(F.col("o_orderstatus") == "P", F.array("o_orderpriority")).otherwise(F.array().cast("array<string>"))
    lists = groups.concat_lists(table(spark, sf_dir, "orders").select("o_custkey", listed.alias("items_of")), ["o_custkey"], "items_of")
    return lists.withColumn("items", F.array_join("items", ","))


@catalog.add("SELECT l_returnflag, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS total, TRUE AS bounded FROM lineitem GROUP BY l_returnflag")
def group_rows_hot(spark, sf_dir):
    """Groups of many thousand rows, in pieces that together hold every row."""
    pieces = groups.group_rows(table(spark, sf_dir, "lineitem"), ["l_returnflag"], F.col("l_orderkey"), piece_rows=1000)
    sizes = pieces.select("l_returnflag", F.size("items").alias("size"), F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x).alias("sum"))
    bounded = F.max("size") <= 2000
    return sizes.groupBy("l_returnflag").agg(F.sum("size").alias("n"), F.sum("sum").alias("total"), bounded.alias("bounded"))


@catalog.add("SELECT l_returnflag, bit_xor(l_orderkey) AS result FROM lineitem GROUP BY l_returnflag")
def group_fold_hot(spark, sf_dir):
    def xor(a, b):
        return a.bitwiseXOR(b)

    items = table(spark, sf_dir, "lineitem")
    return groups.fold_groups(items, ["l_returnflag"], F.col("l_orderkey"), F.lit(0).cast("long"), xor, xor, piece_rows=1000)


@catalog.add("""
    SELECT string_agg(c_mktsegment || '=' || n, ',' ORDER BY c_mktsegment) AS entries
    FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment)
""")
def view_to_map(spark, sf_dir):
    counts = groups.count_groups(table(spark, sf_dir, "customer"), ["c_mktsegment"])
    ordered = F.sort_array(F.map_entries("entries"))
    entry = F.transform(ordered, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.as_map(counts, "c_mktsegment", "n").select(F.array_join(entry, ",").alias("entries"))


@catalog.add("""
    SELECT conv_id, string_agg(role || ':' || n, ',' ORDER BY role) AS entries
    FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY conv_id, role)
    GROUP BY conv_id
""")
def group_to_multimap(spark, sf_dir):
    counts = groups.count_groups(table(spark, sf_dir, "conversations"), ["conv_id", "role"])
    maps = groups.reduce_groups(
        counts, ["conv_id"], entries=F.map_from_entries(F.collect_list(F.struct("role", "n")))
    )
    ordered = F.sort_array(F.map_entries("entries"))
    entry = F.transform(ordered, lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return maps.select("conv_id", F.array_join(entry, ",").alias("entries"))


@catalog.add(rf"""
    WITH w AS (SELECT label, unnest(regexp_extract_all(text, '\w+')) AS word FROM ({SQL_DOC_LABELS}))
    SELECT label, word, 'label_word' AS level, count(*) AS n FROM w GROUP BY label, word
    UNION ALL SELECT label, NULL, 'label_words', count(*) FROM w GROUP BY label
    UNION ALL SELECT label, NULL, 'label', count(*) FROM ({SQL_DOC_LABELS}) GROUP BY label
    UNION ALL SELECT NULL, NULL, 'all', count(*) FROM ({SQL_DOC_LABELS})
""")
def counter_rollup(spark, sf_dir):
    return naive_bayes.counters(documents(spark, sf_dir))


# sets and order -----------------------------------------------------------------------------

@catalog.add("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return sets.distinct_rows(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"))


def _vocabulary(spark, sf_dir, name):
    return rows.flat_map(table(spark, sf_dir, name), words("text"), "word")


@catalog.add(r"""
    SELECT unnest(regexp_extract_all(text, '\w+')) AS word FROM benchmark
    UNION SELECT unnest(regexp_extract_all(text, '\w+')) FROM conversations
    UNION SELECT unnest(string_split(p_name, ' ')) FROM part
""")
def union_distinct(spark, sf_dir):
    names = rows.flat_map(table(spark, sf_dir, "part"), F.split("p_name", " "), "word")
    views = [_vocabulary(spark, sf_dir, "benchmark"), _vocabulary(spark, sf_dir, "conversations"), names]
    return sets.union_distinct(*views)


@catalog.add(r"""
    SELECT unnest(regexp_extract_all(text, '\w+')) AS word FROM benchmark
    EXCEPT SELECT unnest(regexp_extract_all(text, '\w+')) FROM conversations
""")
def vocab_difference(spark, sf_dir):
    return sets.difference(_vocabulary(spark, sf_dir, "benchmark"), _vocabulary(spark, sf_dir, "conversations"))


@catalog.add("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey")
def sort_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy("o_custkey", "o_orderkey")


@catalog.add("""
    SELECT doc_id, row_number() OVER (ORDER BY CAST('0x' || substr(md5('7:0:' || doc_id), 1, 8) AS BIGINT), doc_id) - 1
               AS rank
    FROM documents
""")
def shuffled_row_number(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return ranking.shuffled_rank(ids, "doc_id", seed=7, epoch=0)


# reading results ------------------------------------------------------------------------------

@catalog.add("SELECT count(*) AS orders, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders")
def only_row(spark, sf_dir):
    """The one row of a view, as a value."""
    view = table(spark, sf_dir, "orders").agg(F.count("*").alias("orders"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))
    return spark.createDataFrame([tuple(rows.only_row(view))], view.schema)


@catalog.add("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def show_rows(spark, sf_dir):
    """All rows of a result, read one partition at a time."""
    counts = groups.count_groups(table(spark, sf_dir, "orders"), ["o_orderpriority"])
    return spark.createDataFrame([tuple(r) for r in show(counts)], counts.schema)


@catalog.add("SELECT doc_id % 3 AS worker, doc_id FROM documents")
def take_part(spark, sf_dir):
    """What each of three workers loads; together they load every row."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    loads = [part_of(docs, "doc_id", w, 3).select(F.lit(w).cast("long").alias("worker"), "doc_id") for w in range(3)]
    return loads[0].union(loads[1]).union(loads[2])


def _halves(text):
    """Both halves of a text, cut at a code point; a list that depends on the length of the text."""
    return [text[: len(text) // 2], text[len(text) // 2 :]] if text else []


@catalog.add("""
    SELECT doc_id, md5(half) AS digest FROM (
        SELECT doc_id, unnest([text[1 : length(text) // 2], text[length(text) // 2 + 1 :]]) AS half
        FROM documents WHERE text <> '')
""")
def flat_map_function(spark, sf_dir):
    parts = rows.flat_map_function(table(spark, sf_dir, "documents"), _halves, "text", "half", "string", "doc_id")
    return parts.select("doc_id", F.md5("half").alias("digest"))
