"""Removal of repeated word sequences with suffix automata.

Every word covered by a window of ``WINDOW`` words that also starts earlier in the corpus goes (smaller
document id, or the same document further left). The text to compare with is the corpus itself,
which no task can hold, so it is cut into reference shards by content: :mod:`corpusml.llm.repeats` files
all windows by a run of words they share, and each run's open contents are a shard with a suffix
automaton of its own. It is sent to the task that streams the same run's contents rather than to every
task: no other text can match it in a whole window.

Contents are streamed in document order. Each is first read through the automaton of the earlier ones,
which gives the length of the longest match that ends at every word (matching statistics); where that
reaches ``WINDOW``, the window ending there starts earlier and is removed. Then the content is added.

A null text has no words. Texts of fewer than ``WINDOW`` words stay whole. Rows that repeat a document id
count as the same document, so they do not remove each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusml.llm import repeats
from corpusml.llm.common import as_bytes, covered, prefix_sums, word_hashes, word_spans

WINDOW = 20
RUN = 8


class SuffixAutomaton:
    """All substrings of the sequences added so far, in as many states as twice their items."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, item, target: int) -> int:
        """The state for the matches of ``target`` that are as short as those of ``state`` and one item more."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(item) == target:
            self.next[state][item] = copy
            state = self.link[state]
        return copy

    def add(self, sequence: list) -> None:
        last = 0
        for item in sequence:
            known = self.next[last].get(item)
            if known is not None:
                last = self._split(last, item, known)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            state = last
            while state >= 0 and item not in self.next[state]:
                self.next[state][item] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, item, self.next[state][item])
            last = new

    def matches(self, sequence: list) -> list[int]:
        """Length of the longest match that ends at each item."""
        state, size, sizes = 0, 0, []
        for item in sequence:
            while state and item not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if item in self.next[state]:
                state, size = self.next[state][item], size + 1
            sizes.append(size)
        return sizes


def settle(rows: list[tuple], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Windows of open stretches that also start in an earlier one of the same run."""
    ids, starts = [], []
    run, automaton = None, SuffixAutomaton()
    for i, (key, doc_id, first, windows, piece) in enumerate(rows):
        words = piece.split()
        if key != run:
            run, automaton = key, SuffixAutomaton()
        else:
            found = [at for at, size in enumerate(automaton.matches(words)[window - 1 :]) if size >= window and at < windows]
            ids += [doc_id] * len(found)
            starts += [first + at for at in found]
        if i + 1 < len(rows) and rows[i + 1][0] == run:
            automaton.add(words)
    return repeats.runs_of(np.array(ids, np.int64), np.array(starts, np.int64))


def _sums(raw: bytes) -> np.ndarray:
    return prefix_sums(word_hashes(as_bytes(raw))[0])


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = RUN, idx: str = "doc_id", text: str = "text", wide: int = repeats.WIDE) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` of every document."""

    def slices(raw, firsts, windows):
        starts, ends = word_spans(as_bytes(raw))
        # Words are split by ASCII blanks only, as bytes.split() does.
        return [raw[starts[f] : ends[f + n + window - 2]] if f + n + window - 2 < len(ends) else None for f, n in zip(firsts.tolist(), windows.tolist())]

    def finish(raw, firsts, windows):
        starts, ends = word_spans(as_bytes(raw))
        gone = covered(len(starts), firsts, firsts + windows - 1 + window)
        kept = b" ".join([raw[s:e] for s, e in zip(starts[~gone].tolist(), ends[~gone].tolist())]) if gone.any() else b" ".join(raw.split())
        return len(starts), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept

    removed = repeats.removed_windows(docs, _sums, k, window, slices, lambda rows: settle(rows, window), idx, text, wide=wide)
    arrow = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    return repeats.apply_removed(docs, removed, finish, "n_words long, n_removed long, kept_sha256 string, kept binary", arrow, idx, text)


OP_SQL = rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 0) + 1)) AS s FROM words),
filed AS (SELECT doc_id, s, md5(array_to_string(w[s : s + {WINDOW - 1}], ' ')) AS m FROM starts),
later AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) AS n FROM filed) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, {WINDOW})) AS i FROM later),
lost AS (SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(len(cut), 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)"""
