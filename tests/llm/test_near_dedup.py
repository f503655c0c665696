import re

import numpy as np
import pytest
from helpers import awkward, got, prose, table

from corpusml.llm import near_dedup
from corpusml.llm.components import connected_components


def brute(rows, k, percent=80):
    sets = []
    for _, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(k, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    labels = {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while labels[x] != x:
            x = labels[x]
        return x

    for a, s in zip(rows, sets):
        for b, t in zip(rows, sets):
            if a[0] is not None and b[0] is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a[0]), root(b[0])))
                labels[y] = x
    return sorted(((r[0], len(s), None if r[0] is None else root(r[0]), r[0] is None or r[0] == root(r[0])) for r, s in zip(rows, sets)),
                  key=lambda r: tuple((x is not None, str(x).zfill(9)) for x in r))


def variants(n, changed, seed=0):
    rng = np.random.default_rng(seed)
    base = prose(7, 120).split()
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.choice(len(words), changed, replace=False):
            words[at] = f"new{i}x{at}"
        rows.append((i, " ".join(words), "en", "a", 1))
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_against_brute_force(spark, k):
    rows = awkward()
    assert got(near_dedup.near_duplicates(table(spark, rows), k=k), "doc_id", "n_shingles", "component_id", "kept") == brute(rows, k)


@pytest.mark.parametrize("changed", [1, 2, 3])
def test_groups_of_near_copies(spark, changed, monkeypatch):
    # Two edits leave pairs on both sides of the threshold.
    rows = variants(60, changed) + [(100 + i, prose(50 + i), "en", "a", 1) for i in range(20)]
    wanted = brute(rows, 4)
    assert got(near_dedup.near_duplicates(table(spark, rows), k=4), "doc_id", "n_shingles", "component_id", "kept") == wanted
    # Small limits take the ways for large keys and large clusters.
    monkeypatch.setattr(near_dedup, "STAR", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    assert got(near_dedup.near_duplicates(table(spark, rows), k=4), "doc_id", "n_shingles", "component_id", "kept") == wanted


def test_empty_table(spark):
    assert near_dedup.near_duplicates(table(spark, [])).collect() == []


def test_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 2**63, near_dedup.SYMBOLS, dtype=np.uint64)
        b = a.copy()
        used = near_dedup.CHUNKS * near_dedup.WIDTH
        b[rng.choice(used, 2 * near_dedup.CHUNKS - 1, replace=False)] += np.uint64(1)
        assert set(near_dedup.index_keys(a)) & set(near_dedup.index_keys(b))
        assert near_dedup.differing(near_dedup.sketch(a), near_dedup.sketch(b)) <= 2 * near_dedup.CHUNKS - 1


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 40), (40, 41), (7, 7), (200, 41)]
    found = dict(got(connected_components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert found == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 100: 40, 200: 40}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
