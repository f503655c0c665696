import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from corpusml import storage
from corpusml.sources import sinks, text


def write(folder, *files):
    folder.mkdir()
    for name, content in files:
        (folder / name).write_text(content, encoding="utf-8")
    return str(folder)


def test_labelled_documents(spark, tmp_path):
    where = write(tmp_path / "in", ("a.txt", 'd1\tPerson,Agent\tHe said "hi, there"\nd2\t\tno label\nd3\tPlace\t\n'))
    assert rows(text.read_labelled(spark, where)) == [
        ("d1", ["Person", "Agent"], 'He said "hi, there"'), ("d2", [], "no label"), ("d3", ["Place"], ""),
    ]
    assert rows(text.read_unlabelled(spark, where))[0] == ("d1", 'He said "hi, there"')


def test_entities_keep_file_order(spark, tmp_path):
    lines = [f"name_{i}%C3%A9\tL{i % 3},M" for i in range(50)]
    where = write(tmp_path / "in", ("b.txt", "\n".join(lines[20:]) + "\n"), ("a.txt", "\n".join(lines[:20]) + "\n"))
    got = text.read_entities(spark, where).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(50))
    assert [r["entity"] for r in got] == [f"name_{i}é" for i in range(50)]
    assert got[4]["labels"] == ["L1", "M"]


def test_line_numbers_over_many_splits(spark, tmp_path):
    where = write(tmp_path / "in", ("a.txt", "".join(f"{i},{i + 1}\n" for i in range(5000))))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = text.numbered_lines(spark, where)
        assert lines.select("block").distinct().count() > 5
        got = text.read_id_lists(spark, where).filter(F.col("doc_id") != F.col("words")[0])
        assert got.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_id_lists_and_parts(spark, tmp_path):
    where = write(tmp_path / "in", ("a.txt", "3,17,3,204\n5\n1,2\n"))
    docs = text.read_id_lists(spark, where)
    assert rows(docs) == [(0, [3, 17, 3, 204]), (1, [5]), (2, [1, 2])]
    assert rows(text.take_part(docs, "doc_id", 0, 2).select("doc_id")) == [(0,), (2,)]
    assert text.distribute(docs, "doc_id", 3).rdd.getNumPartitions() == 3


def test_counters_round_trip(spark, path):
    counters = spark.createDataFrame(
        [("Y", "Why", "label_word", 2), ("Y", None, "label_words", 2), ("Y", None, "label", 1), (None, None, "all", 1)],
        "label string, word string, level string, n long",
    )
    sinks.write_counters(counters, path)
    assert rows(text.read_lines(spark, path)) == [("Y=*\t1",), ("Y=Y\t1",), ("Y=Y,W=*\t2",), ("Y=Y,W=Why\t2",)]
    assert rows(text.read_counters(spark, path)) == [("Y", "Why", 2)]


def test_prediction_lines(spark):
    df = spark.createDataFrame([([("A", 0.25), ("B", 0.5)],)], "scores array<struct<label:string,p:double>>")
    assert df.select(sinks.prediction_line().alias("x")).first()["x"] == "A\t0.25,B\t0.5"


def test_word_topic_and_vocabulary_round_trip(spark, tmp_path):
    counts = spark.createDataFrame([(0, 1, 5), (2, 0, 3_000_000_000), (2, 2, 1)], "word_id int, topic int, n long")
    sinks.write_word_topics(counts, 3, str(tmp_path / "wt"), 4)
    # A line for every id, also for words that do not occur.
    assert [r["value"] for r in text.read_lines(spark, str(tmp_path / "wt")).collect()] == ["0,5,0", "0,0,0", "3000000000,0,1", "0,0,0"]
    got = text.read_word_topics(spark, str(tmp_path / "wt")).filter("n > 0")
    assert rows(got.select("word_id", "topic", "n")) == [(0, 1, 5), (2, 0, 3_000_000_000), (2, 2, 1)]
    with pytest.raises(Exception, match="expected 2 topics, found 3"):
        text.read_word_topics(spark, str(tmp_path / "wt"), 2).collect()
    words = spark.createDataFrame([("zebra",), ("apple",)], "w string").coalesce(1)
    sinks.write_lines(words, F.col("w"), str(tmp_path / "v"))
    assert rows(text.read_vocabulary(spark, str(tmp_path / "v"))) == [(0, "zebra"), (1, "apple")]


def test_other_sinks(spark, tmp_path):
    history = spark.createDataFrame([(2, 1.5, -3.0), (1, 0.5, -4.0)], "iteration int, seconds double, likelihood double")
    sinks.write_likelihood(history, str(tmp_path / "llh"))
    assert [r["value"] for r in text.read_lines(spark, str(tmp_path / "llh")).collect()] == ["1,0.5,-4.0", "2,1.5,-3.0"]
    topics = spark.createDataFrame([(0, ["a", "b"])], "topic int, words array<string>")
    sinks.write_topic_words(topics, str(tmp_path / "t"))
    assert rows(text.read_lines(spark, str(tmp_path / "t"))) == [("0,a,b",)]
    probs = spark.createDataFrame([(1, [0.5]), (0, [0.25])], "idx long, probs array<double>")
    sinks.write_probabilities(probs, str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p")).collect()
    assert [(r["idx"], r["probs"]) for r in stored] == [(0, [0.25]), (1, [0.5])]
    assert len(list(sinks.show_rows(probs))) == 2


def test_stored_views_keep_nested_values(spark, path):
    view = spark.sql("SELECT 'a' AS s, 1 AS i, 2.5D AS d, array('x') AS xs, map('k', 1) AS m, struct(1, 'z') AS t, null AS n")
    view = view.withColumn("n", F.col("n").cast("string"))
    storage.store(view, path)
    assert storage.reuse(spark, path).first() == view.first()


def test_materialize_and_discard_stay_in_the_shared_folder(spark, path):
    kept = storage.store(spark.range(3), path)
    mine = storage.materialize(spark.range(5).withColumn("p", F.col("id") % 2), "t", ["p"])
    assert storage.shared_folder(spark) in mine.inputFiles()[0]
    other = storage.materialize(spark.range(4), "t")
    storage.discard(kept)
    storage.discard(other.filter("id = 1"))
    assert kept.count() == 3 and other.count() == 4
    storage.discard(mine)
    with pytest.raises(Exception):
        mine.count()
