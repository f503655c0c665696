import re

import corpus_pipeline
import duckdb
import pytest
from helpers import CLASHES, awkward, prose, table
from test_near_dedup import brute
from test_tables import brute_spans, brute_targets

import __spark_entry__ as entry
import check
from corpusml.llm.queries import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.sql))
def test_query_agrees_with_sql(spark, name):
    side = duckdb.connect()
    for t in check.TABLES:
        side.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    result = catalog.queries[name](spark, FOLDER)
    got = result.collect()
    wanted = side.execute(catalog.sql[name])
    columns = [c[0] for c in wanted.description]
    assert got and check.compare(result.columns, got, columns, wanted.fetchall()) == ""


def test_registered():
    assert {n.split("_")[0] for n in catalog.queries} == {f"op{i}" for i in range(1, 14)}
    assert {"pipeline", *catalog.queries} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "mixing"]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame([(i, i % 2, int(i >= 40)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(77, 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def rows():
    clean = [(i, prose(1000 + i, 40), "en", "abc"[i % 3], 1) for i in range(40)]
    toxic = [(i, prose(1000 + i, 40) + (" idiot moron" if i % 2 else " id10t m0ron idiot moron"), "en", "a", 1) for i in range(40, 60)]
    return clean + toxic + [
        (70, prose(1000, 40) + " more", "en", "a", 1), (71, prose(77, 30) + " " + prose(78, 50), "en", "b", 1), (72, "x token = 0123456789abcdef0123 y " + prose(79), "en", "c", 5),
    ]


def test_stages_take_effect(spark, folder):
    docs = table(spark, rows())
    kept = corpus_pipeline.reject_toxic(spark, docs, folder)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows() if not 40 <= r[0] < 60}
    single = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert {r["doc_id"] for r in single.collect()} == {r[0] for r in brute(rows(), 5) if r[3]} and 70 not in {r["doc_id"] for r in single.collect()}
    clean = corpus_pipeline.drop_contaminated(spark, docs, folder)
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows()} - {71}
    redacted = {r["doc_id"]: r for r in corpus_pipeline.redact_secrets(spark, docs, folder).collect()}
    for doc_id, text, *_ in rows():
        assert (redacted[doc_id]["text"] == text) == (not brute_spans(text))
    assert redacted[72]["text"] == "x [secret] y " + prose(79) and redacted[72]["n_chars"] == len(redacted[72]["text"])
    for stage in (kept, single, clean, corpus_pipeline.redact_secrets(spark, docs, folder)):
        assert stage.columns == docs.columns
    mixed = corpus_pipeline.mix_sources(spark, docs.drop("mix_size"), folder).collect()
    sizes = {s: sum(len(re.findall(r"\S+", r[1])) for r in rows() if r[3] == s) for s in "abc"}
    for s, target in brute_targets(sizes).items():
        assert abs(sum(r["mix_taken"] for r in mixed if r["source"] == s) - target) <= 100
    assert all(r["mix_copies"] > 0 for r in mixed)


def test_awkward_rows_pass_through_all_stages(spark, folder):
    docs = table(spark, awkward())
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/out-{name}")
        docs = spark.read.parquet(f"{folder}/out-{name}")
        assert set(CLASHES) <= set(docs.columns)
    ids = [r["doc_id"] for r in docs.collect()]
    # Exact and near copies and repeated rows are gone, the document without an id is not dropped by them.
    assert len(ids) == len(set(ids)) and not {1, 2} & set(ids)


def test_empty_tables_pass_through_all_stages(spark, folder):
    docs = table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/none-{name}")
        docs = spark.read.parquet(f"{folder}/none-{name}")
    assert docs.count() == 0
