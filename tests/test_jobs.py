import pytest
from frames import rows
from pyspark.sql import functions as F

from corpusml import jobs
from corpusml.sources import text

TRAIN = """a\tfruit\tapple berry apple
b\tfruit,red\tberry cherry
c\ttool\thammer nail saw
d\ttool\tnail nail
"""
TEST = """x\t\tapple and berry
y\t\tnail
z\t\t
"""


@pytest.fixture
def files(tmp_path):
    for name, content in (("train", TRAIN), ("test", TEST)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.txt").write_text(content)
    return tmp_path


def lines(spark, path):
    return [r["value"] for r in text.read_lines(spark, str(path)).collect()]


def test_count_words(spark, files):
    jobs.count_words(spark, str(files / "train"), str(files / "out"), k=1)
    assert sorted(lines(spark, files / "out/top_words")) == ["fruit\tapple\t2", "red\tberry\t1", "tool\tnail\t3"]
    counters = dict(line.split("\t") for line in lines(spark, files / "out/counters"))
    assert counters["Y=*"] == "5" and counters["Y=tool,W=*"] == "5" and counters["Y=fruit,W=berry"] == "2"


def test_naive_bayes(spark, files):
    jobs.classify_naive_bayes(spark, str(files / "train"), str(files / "test"), str(files / "out"))
    got = dict(line.split("\t")[:2] for line in lines(spark, files / "out"))
    assert got["x"] == "fruit" and got["y"] == "tool" and set(got) == {"x", "y", "z"}


def test_logistic(spark, files):
    jobs.classify_logistic(
        spark, str(files / "train"), str(files / "test"), str(files / "out"), buckets=512, epochs=3, batch_size=2
    )
    got = [dict(pair.split("\t") for pair in line.split(",")) for line in lines(spark, files / "out")]
    assert [set(g) for g in got] == [{"fruit", "red", "tool"}] * 3
    assert float(got[0]["fruit"]) > 0.5 > float(got[0]["tool"]) and float(got[1]["tool"]) > 0.5
    assert set(got[2].values()) == {"0.5"}


@pytest.mark.parametrize("model", ["mlp", "lstm"])
def test_network(spark, tmp_path, model):
    (tmp_path / "names").mkdir()
    names = "".join(f"{'ab'[i % 2]}{i}%20x\t{'PQ'[i % 2]}\n" for i in range(20))
    (tmp_path / "names/part.txt").write_text(names)
    where, out = str(tmp_path / "names"), tmp_path / "out"
    jobs.train_network(spark, where, where, where, str(out), model, max_len=4, hidden=4, batch_size=10, epochs=2)
    probs = spark.read.parquet(str(out / "probabilities")).collect()
    assert [r["idx"] for r in probs] == list(range(20)) and len(probs[0]["probs"]) == 2
    assert spark.read.parquet(str(out / "train_loss")).count() == 4
    assert spark.read.parquet(str(out / "valid_loss")).count() == 2
    assert spark.read.parquet(str(out / "test_loss")).first()["loss"] > 0
    assert {r["name"] for r in spark.read.parquet(str(out / "parameters")).collect()} >= {"w2", "b2"}


def test_topics(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/part.txt").write_text("0,1,1,2\n3,4\n0,0\n")
    (tmp_path / "vocab").mkdir()
    (tmp_path / "vocab/part.txt").write_text("v0\nv1\nv2\nv3\nv4\n")
    out = tmp_path / "out"
    jobs.train_topics(
        spark, str(tmp_path / "docs"), str(out), topics_wanted=2, sweeps=2, vocabulary=str(tmp_path / "vocab"), k=2
    )
    # Line numbers count over the files in path order.
    files = sorted((out / "word_topics").glob("part-*.txt"))
    table = [list(map(int, line.split(","))) for f in files for line in f.read_text().split()]
    assert [sum(row) for row in table] == [3, 2, 1, 1, 1]
    assert [line.split(",")[0] for line in lines(spark, out / "likelihood")] == ["1", "2"]
    assert all(w[0] == "v" for line in lines(spark, out / "topic_words") for w in line.split(",")[1:])


def test_parameters():
    got = jobs.read_parameters(jobs.classify_naive_bayes, "train:a%2Cb,test:c,output:s3%3A%2F%2Fd,compat:true")
    assert got == {"train": "a,b", "test": "c", "output": "s3://d", "compat": True}
    assert jobs.read_parameters(jobs.count_words, "train:a,output:b,k:3")["k"] == 3
    with pytest.raises(ValueError):
        jobs.read_parameters(jobs.count_words, "train:a")
    with pytest.raises(ValueError):
        jobs.read_parameters(jobs.count_words, "train:a,output:b,nope:1")
