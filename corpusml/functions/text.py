"""Tokenizers, percent-decoding and hashing as JVM-side column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The English stop-word list that defines the filtered tokenizer.
ENGLISH_STOP_WORDS = tuple(
    """
    a about above after again against ain all am an and any are aren as at be because been before
    being below between both but by can couldn d did didn do does doesn doing don down during each
    few for from further had hadn has hasn have haven having he her here hers herself him himself
    his how i if in into is isn it its itself just ll m ma me mightn more most mustn my myself needn
    no nor not now o of off on once only or other our ours ourselves out over own re s same shan she
    should shouldn so some such t than that the their theirs them themselves then there these they
    this those through to too under until up ve very was wasn we were weren what when where which
    while who whom why will with won wouldn y you your yours yourself yourselves
    """.split()
)


def words(text: Column | str) -> Column:
    """Array of maximal runs of ASCII letters, digits and underscore, case kept."""
    return F.regexp_extract_all(text, F.lit(r"\w+"), F.lit(0))


_WORD = re.compile(rb"[A-Za-z0-9_]+")


def find_words(raw: bytes | None) -> list[bytes]:
    """:func:`words` of a text given as UTF-8 bytes, inside a Python task; none for NULL."""
    return _WORD.findall(raw) if raw else []


def distinct_words(docs: DataFrame) -> DataFrame:
    """``(word)``: the words of the column ``text``, each at least once; most repeats are dropped in the tasks."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for part in parts:
            for raw in part.column("raw").to_pylist():
                known.update(find_words(raw))
                if len(known) > 1_000_000:
                    yield _word_batch(known)
                    known = set()
        if known:
            yield _word_batch(known)

    return docs.select(F.col("text").cast("binary").alias("raw")).mapInArrow(run, "word string")


def _word_batch(known: set[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(known), pa.binary()).cast(pa.string())], names=["word"])


def lower_words(text: Column | str) -> Column:
    """:func:`words` in lower case (split first, so case mapping cannot create tokens)."""
    return F.transform(words(text), F.lower)


def content_words(text: Column | str) -> Column:
    """:func:`lower_words` without the English stop words."""
    return F.filter(lower_words(text), is_content_word)


def is_content_word(word: Column) -> Column:
    return ~word.isin(*ENGLISH_STOP_WORDS)


def whitespace_tokens(text: Column | str) -> Column:
    """Lower-case tokens separated by white space."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\S+"), F.lit(0))


def percent_decode(text: Column | str) -> Column:
    """Decode ``%xx`` escapes as UTF-8 and strip the ends.

    ``+`` is an ordinary character here, and a percent sign without two hexadecimal digits
    stands for itself; both are escaped before the built-in decoder sees them.
    """
    text = F.col(text) if isinstance(text, str) else text
    safe = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.coalesce(decoded, text), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def hash_bucket(value: Column | str, buckets: int, portable: bool = False) -> Column:
    """Non-negative bucket of a string.

    The default is Spark's 64-bit hash. ``portable`` takes the first 32 bits of the MD5
    digest, which other SQL engines compute alike.
    """
    value = F.col(value) if isinstance(value, str) else value
    size = F.lit(buckets).cast("long")
    bucket = digest_bits(value) % size if portable else F.pmod(F.xxhash64(value), size)
    return _never_null(bucket)


def digest_bits(value: Column, digits: int = 8) -> Column:
    """First hexadecimal digits (at most 15) of the MD5 digest of a string, as a non-negative long; 0 for NULL."""
    return _never_null(F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long"))


def _never_null(number: Column) -> Column:
    # A join on a value that might be NULL filters it first, and the filter moves below the
    # grouping that made the join side small: the hash would run twice, once per token.
    return F.coalesce(number, F.lit(0).cast("long"))


def characters(text: Column | str) -> Column:
    """Array of the characters of a string; empty for an empty string."""
    return F.filter(F.split(text, ""), lambda c: F.length(c) > 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def term_counts(terms: Column) -> Column:
    """``array<(term, n)>``: the distinct entries of an array with their numbers, in sorted order.

    All of it happens inside the row, so rows are exploded by distinct terms and need no shuffle
    to be counted. NULL for an empty array.
    """

    def fold(a: Column) -> Column:
        n = F.size(a)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))

        def run(s: Column) -> Column:
            def one(i: Column, k: Column) -> Column:
                return F.struct(F.get(a, i).alias("term"), (F.coalesce(F.get(s, k + 1), n) - i).cast("long").alias("n"))

            return F.transform(s, one)

        return let(starts, run)

    return let(terms, lambda t: F.when(F.size(t) > 0, let(F.sort_array(t), fold)))


def explode_terms(df: DataFrame, terms: Column | str, *keep: str, term: str = "term", n: str = "n") -> DataFrame:
    """One row per entry of a :func:`term_counts` array.

    The outer form, because for the inner one Spark adds a filter that computes the array once or twice more.
    """
    rows = df.select(*keep, F.explode_outer(terms).alias("_entry")).filter(F.col("_entry").isNotNull())
    return rows.select(*keep, F.col("_entry.term").alias(term), F.col("_entry.n").alias(n))
