import re

import duckdb
import pytest

import __spark_entry__ as entry
import check

FOLDER = "/root/testdata/sf0.001"

SAMPLED = """top_words_per_label counter_rollup join_full group_rows nb_predict nb_predict_compat lr_train_predict
mlp_gradient minibatch_assign lda_log_likelihood labelled_documents_file entity_file word_topic_file""".split()


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    own = {name for name in set(queries) - set(sql) if not re.fullmatch(r"op\d+_.*|pipeline", name)}
    assert own == set()
    assert entry.entry(spark).columns == ["label", "word", "n", "rank"]


@pytest.fixture(scope="module")
def sql_side():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLED)
def test_query_agrees_with_sql(spark, sql_side, name):
    result = entry.queries()[name](spark, FOLDER)
    got = result.collect()
    wanted = sql_side.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    assert got and check.compare(result.columns, got, columns, wanted.fetchall()) == ""
