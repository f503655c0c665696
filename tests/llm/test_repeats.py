import hashlib
import random
import re

import numpy as np
import pytest
from helpers import awkward, got, prose, table
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusml.llm import repeats, substring_dedup, suffix_dedup


def brute_bytes(rows, window):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for s in range(len(raw) - window + 1):
            if raw[s : s + window] in seen:
                gone[s : s + window] = [True] * window
            seen.add(raw[s : s + window])
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return out


def brute_words(rows, window):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(" ".join(w for w, g in zip(words, gone) if not g).encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, str(x).zfill(9)) for x in row)


def once(rows):
    """Rows that repeat an id are one document to both operators."""
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize("wide", [repeats.WIDE, 1])
def test_bytes_against_brute_force(spark, wide):
    rows = once(awkward())
    wanted = sorted(brute_bytes([r[:2] for r in rows], 100), key=key)
    result = suffix_dedup.without_repeats(table(spark, rows), wide=wide)
    assert got(result, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == wanted


@pytest.mark.parametrize("wide", [repeats.WIDE, 1])
def test_words_against_brute_force(spark, wide):
    rows = once(awkward())
    wanted = sorted(brute_words([r[:2] for r in rows], 20), key=key)
    result = substring_dedup.without_repeats(table(spark, rows), wide=wide)
    assert got(result, "doc_id", "n_words", "n_removed", "kept_sha256") == wanted


def test_a_passage_in_many_documents(spark):
    passage = prose(9, 50)
    rows = [(i, prose(100 + i, 30) + " " + passage + " " + prose(500 + i, 30), "en", "a", 1) for i in range(120)]
    assert got(suffix_dedup.without_repeats(table(spark, rows), wide=20), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute_bytes([r[:2] for r in rows], 100), key=key)
    assert got(substring_dedup.without_repeats(table(spark, rows), wide=20), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_words([r[:2] for r in rows], 20), key=key)


@pytest.mark.parametrize("module", [suffix_dedup, substring_dedup])
def test_repeated_ids_and_empty_tables(spark, module):
    twice = [(1, prose(1), "en", "a", 1), (1, prose(1), "en", "a", 1)]
    assert got(module.without_repeats(table(spark, twice)), "n_removed") == [(0,), (0,)]
    assert module.without_repeats(table(spark, [])).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.integers(2, 70))
def test_suffix_array(values, depth):
    text = np.array(values, np.uint8)
    order = suffix_dedup.suffix_array(text, depth)
    raw = text.tobytes()
    heads = [raw[i : i + depth] for i in order]
    assert sorted(order.tolist()) == list(range(len(raw))) and heads == sorted(heads)
    same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a + b"\0" * depth, b + b"\0" * depth)) if x != y), depth)
    assert suffix_dedup.common_prefixes(text, order, depth)[1:].tolist() == [min(depth, same(raw[a:], raw[b:])) for a, b in zip(order, order[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=15), max_size=4), st.lists(st.integers(0, 2), max_size=20))
def test_automaton(known, sequence):
    automaton = substring_dedup.SuffixAutomaton()
    for k in known:
        automaton.add(k)
    runs = {tuple(k[a:b]) for k in known for a in range(len(k)) for b in range(a + 1, len(k) + 1)}
    wanted = [max((n for n in range(1, e + 1) if tuple(sequence[e - n : e]) in runs), default=0) for e in range(1, len(sequence) + 1)]
    assert automaton.matches(sequence) == wanted


def test_windows_are_filed_by_content():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 50, 400).astype(np.uint64) << np.uint64(40)
    firsts, lasts, at = repeats.file_windows(values, 7)
    assert firsts[0] == 0 and lasts[-1] == 393 and (firsts[1:] == lasts[:-1] + 1).all()
    for f, e, p in zip(firsts, lasts, at):
        assert all(s + int(np.argmin(values[s : s + 7])) == p for s in range(f, e + 1))


def test_batches_do_not_matter(spark):
    rng = random.Random(3)
    lines = [prose(s, 25) for s in range(12)]
    rows = [(i, " ".join(rng.choice(lines) for _ in range(6)), "en", "a", 1) for i in range(60)]
    wanted = sorted(brute_words([r[:2] for r in rows], 20), key=key)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("3", "1000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert got(substring_dedup.without_repeats(table(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == wanted
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
