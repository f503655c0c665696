"""Whole jobs from files to files, and their command line.

    spark-submit corpusml_job.py naive_bayes --params train:hdfs%3A%2F%2F…,test:…,output:…

Parameter values are percent-decoded. Each job is a plain function, so the same names work as
keyword arguments from Python.
"""

from __future__ import annotations

import argparse
import inspect
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.plans import characters, logistic, naive_bayes, networks, topics
from corpusml.session import build_session
from corpusml.sources import sinks, text
from corpusml.storage import materialize


def count_words(spark: SparkSession, train: str, output: str, k: int = 10) -> None:
    """Counters of labelled documents (``counters``) and the top words per label (``top_words``)."""
    model = naive_bayes.count(text.read_labelled(spark, train), content_only=False).stored()
    sinks.write_counters(naive_bayes.roll_up_counters(model.words, model.labels), f"{output}/counters")
    sinks.write_top_words(naive_bayes.top_words(model.words, k), f"{output}/top_words")


def classify_naive_bayes(spark: SparkSession, train: str, test: str, output: str, compat: bool = False) -> None:
    """``doc_id \\t label \\t score`` lines for the test documents."""
    model = naive_bayes.count(text.read_labelled(spark, train), compat=compat).stored()
    chosen = naive_bayes.predict(model, text.read_unlabelled(spark, test))
    sinks.write_lines(chosen, F.concat_ws("\t", "doc_id", "label", F.col("score").cast("string")), output)


def classify_logistic(
    spark: SparkSession, train: str, test: str, output: str, buckets: int = 1 << 18, learning_rate: float = 0.5,
    decay_rate: float = 0.1, epochs: int = 20, steps: int = 100, decay_threshold: float = 0.8, seed: int = 0, batch_size: int = 0,
) -> None:
    """``label \\t p,label \\t p,…`` lines in the order of the test documents."""
    settings = logistic.Settings(buckets, learning_rate, decay_rate, epochs, steps, decay_threshold, seed, batch_size=batch_size or None)

    def documents(path: str) -> DataFrame:
        # A line is a document, whatever its name.
        read = text.read_labelled(spark, path, numbered=True)
        return materialize(read.select(F.col("idx").alias("doc_id"), "labels", "text"), "job-documents")

    docs = documents(train)
    model = logistic.train(docs, logistic.label_index(docs), settings)
    scored = logistic.predict(documents(test), model, settings)
    sinks.write_lines(scored.orderBy("doc_id"), sinks.prediction_line(), output)


def train_network(
    spark: SparkSession, train: str, valid: str, test: str, output: str, model: str = "mlp", max_len: int = 10,
    hidden: int = 50, batch_size: int = 64, epochs: int = 15, learning_rate: float = 0.5, seed: int = 0,
) -> None:
    """``probabilities`` of the test entities in their order, ``train_loss``, ``valid_loss``,
    ``test_loss`` and the ``parameters``."""
    views = [materialize(text.read_entities(spark, path), "job-entities") for path in (train, valid, test)]
    chars, labels = characters.dictionaries(*views, labelled=views[:2])
    shape = networks.Shape(chars.count(), labels.count(), max_len, hidden)
    kind = {"mlp": networks.MLP, "lstm": networks.LSTM}[model]
    ready = [networks.prepare(characters.encode(view, chars, labels), shape, kind) for view in views]
    settings = networks.Settings(epochs, batch_size, learning_rate, seed)
    trained = networks.train(ready[0], ready[1], kind, shape, settings)
    scored = materialize(networks.predict(ready[2], kind, shape, trained.parameters), "job-scored")
    sinks.write_probabilities(scored, f"{output}/probabilities")
    scored.agg(F.avg("loss").alias("loss")).write.mode("overwrite").parquet(f"{output}/test_loss")
    trained.series("train").write.mode("overwrite").parquet(f"{output}/train_loss")
    trained.series("valid").write.mode("overwrite").parquet(f"{output}/valid_loss")
    networks.save_parameters(spark, trained.parameters, f"{output}/parameters")


def train_topics(
    spark: SparkSession, data: str, output: str, topics_wanted: int = 10, alpha: float = 0.1, beta: float = 0.1,
    sweeps: int = 10, clocks: int = 1, num_words: int = 0, seed: int = 0, vocabulary: str = "", k: int = 10,
) -> None:
    """``word_topics`` and ``likelihood`` tables, and with a vocabulary file ``topic_words``."""
    docs = materialize(text.read_id_lists(spark, data), "job-documents")
    settings = topics.Settings(topics_wanted, alpha, beta, sweeps, clocks, seed)
    num_words = num_words or topics.num_words(docs)
    trained = topics.train(docs, num_words, settings)
    sinks.write_word_topics(trained.word_topics, topics_wanted, f"{output}/word_topics", num_words)
    history = spark.createDataFrame(trained.history, "iteration int, seconds double, likelihood double")
    sinks.write_likelihood(history, f"{output}/likelihood")
    if vocabulary:
        words = text.read_vocabulary(spark, vocabulary)
        sinks.write_topic_words(topics.topic_words(trained.word_topics, words, k), f"{output}/topic_words")


JOBS: dict[str, Callable] = {
    "count_words": count_words,
    "naive_bayes": classify_naive_bayes,
    "logistic": classify_logistic,
    "network": train_network,
    "topics": train_topics,
}


def read_parameters(job: Callable, given: str) -> dict:
    """``name:value,…`` as typed keyword arguments; unknown and missing names are errors."""
    known = {name: p for name, p in inspect.signature(job).parameters.items() if name != "spark"}
    values = {}
    for pair in filter(None, given.split(",")):
        name, _, value = pair.partition(":")
        if name not in known:
            raise ValueError(f"unknown parameter {name}; known are {', '.join(known)}")
        default, value = known[name].default, unquote(value)
        if isinstance(default, bool):
            values[name] = value.lower() in ("1", "true", "yes")
        elif default is inspect.Parameter.empty:
            values[name] = value
        else:
            values[name] = type(default)(value)
    missing = [n for n, p in known.items() if p.default is inspect.Parameter.empty and n not in values]
    if missing:
        raise ValueError(f"missing parameters: {', '.join(missing)}")
    return values


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--params", default="", help="name:value,name:value,… with percent-encoded values")
    options = parser.parse_args(arguments)
    job = JOBS[options.job]
    parameters = read_parameters(job, options.params)
    job(build_session(f"corpusml {options.job}"), **parameters)


if __name__ == "__main__":
    main()
