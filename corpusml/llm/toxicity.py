"""Toxicity scores on text restored by a noisy-channel decoder.

A character language model (four letters, interpolated with shorter contexts) is counted over
all documents. Every word for which the lattice below offers more than its own letters is
decoded: every written character opens the letters it may stand for (itself, leetspeak look-alikes,
any letter for an asterisk, nothing for a separator or a stretched letter), each at a channel cost,
and a Viterbi search over this lattice finds the letters with the least total of channel and
language-model cost. The gate is read from the same tables: a look-alike or separator anywhere in a
word with a letter, or a doubled letter. Two and more single letters with blanks or separators between
them are decoded joined, and once more with every gap either a blank or nothing, so that words beside
a spelled one ("a m.o.r.o.n") come off it. A document then counts as the set of its plain and its
restored words.

Scores are learned on a bounded sample of labelled rows (``TRAIN_ROWS``), restored in the same
way: words whose presence goes with toxic labels far beyond chance (likelihood ratio) get the
logarithm of their odds ratio as weight, at most ``MAX_WORDS`` of them, and a document's score is
the logistic of the base rate of documents without such a word plus the weights of its own.

Counting sends at most 27 ** 4 sums for each task into one aggregation; model and word weights
have fixed bounds and are broadcast; scoring is a map without a shuffle. Whole texts are read, and
decoded words are remembered per task in a table that is emptied when full.

A null or empty text scores the base rate; without labelled rows every score is 0; repeated rows
are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import LOWER, slices, utf8, word_spans
from corpusml.llm.labels import held_out, training_sample

TRAIN_ROWS = 6000
MAX_WORDS = 2000
THRESHOLD = 0.5
REMEMBERED = 200_000

LETTERS = 27  # code 0 is everything that is no letter
# Letters that a written character may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_~*'^"
SWAP, WILD, DROP, STRETCH = 1.0, 3.0, 0.5, 0.7

_EDGES = "\"'`.,;:?!()[]{}<>&#%~^/\\=*_-|+"
_CLOSING = re.compile(r"([^\w\s])\1{2,}$")
#: Look-alikes beyond ASCII as single bytes that UTF-8 does not use, so that all gates are byte-wise.
_FOLDED = {c.encode(): bytes([0xF8 + i]) for i, c in enumerate(c for c in LOOKALIKES if ord(c) >= 128)}
_LOOKS = b"".join(_FOLDED.get(c.encode(), c.encode()) for c in LOOKALIKES)
_GAPS = b" \t\n\x0b\x0c\r" + SEPARATORS.encode()
_SOLO, _GAP = b"[a-z" + re.escape(_LOOKS) + b"]", b"[" + re.escape(_GAPS) + b"]"
_BEFORE, _AFTER = rb"(?<![a-z0-9\x80-\xff])", rb"(?![a-z0-9\x80-\xff])"
#: Two and more single letters with any gaps between them; inside it, four and more with the same single separator.
_SPELLED = re.compile(_BEFORE + _SOLO + b"(?:" + _GAP + b"++" + _SOLO + b")+" + _AFTER)
_EVEN = re.compile(_BEFORE + _SOLO + b"(?:(" + _GAP + b")" + _SOLO + rb")(?:\1" + _SOLO + b"){2,}" + _AFTER)

#: Letters that stand for themselves only.
_CERTAIN = re.compile(r"(?:([a-z])(?!\1))+")

# Classes of bytes: upper case becomes lower case, other ASCII that is no letter splits plain words.
_LOWER = bytes(LOWER)
_PLAIN = bytes(LOWER[c] if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_LETTER = np.array([(c >= 128 or chr(c).isalpha()) and c not in _LOOKS for c in range(256)])
_ASCII = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
_MARK = np.array([c in _LOOKS + SEPARATORS.encode() for c in range(256)])
_GAPPED = np.array([c in _GAPS for c in range(256)])
_SINGLE = _ASCII | np.array([c in _LOOKS for c in range(256)])
_JOINED = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])

_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)


def count_letters(docs: DataFrame, text: str) -> DataFrame:
    """``(run, n)``: how often each run of four letter codes occurs in all texts together."""

    def run(parts):
        total = np.zeros(LETTERS**4, np.int64)
        for part in parts:
            waiting, size = [b"\n\n\n"], 0
            for raw in [*part.column(0).to_pylist(), None]:
                waiting.append(raw or b"")
                size += len(waiting[-1])
                if raw is None or size > 1 << 20:
                    codes = _CODE[np.frombuffer(b"\n\n\n".join(waiting), np.uint8)]
                    total += np.bincount(((codes[:-3] * LETTERS + codes[1:-2]) * LETTERS + codes[2:-1]) * LETTERS + codes[3:], minlength=len(total))
                    waiting, size = [b"\n\n\n"], 0
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["run", "n"])

    counted = docs.select(utf8(text).alias("raw")).mapInArrow(run, "run long, n long")
    return counted.groupBy("run").agg(F.sum("n").alias("n"))


def letter_costs(runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Cost (negative logarithm) of each letter after each three, from run counts."""
    table = np.zeros(LETTERS**4)
    table[runs] = counts
    four = table.reshape(LETTERS, LETTERS, LETTERS, LETTERS)
    mixed = np.full(LETTERS, 1 / LETTERS)
    for order in (four.sum((0, 1, 2)), four.sum((0, 1)), four.sum(0), four):
        total = order.sum(-1, keepdims=True)
        # Contexts that are seldom seen lean on the shorter one.
        mixed = (order + 20 * mixed) / (total + 20)
    return -np.log(mixed).astype(np.float32).reshape(-1)


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Costs from all documents; the counts have at most 27 ** 4 rows whatever the input."""
    counted = count_letters(docs, text).toPandas()
    return letter_costs(counted["run"].to_numpy(np.int64), counted["n"].to_numpy(np.float64))


def _options(char: str, before: str) -> list[tuple[int, float]]:
    """``(letter code or -1 for nothing, channel cost)`` of one written character."""
    found = []
    if "a" <= char <= "z":
        found.append((ord(char) - 96, 0.0))
        if char == before:
            found.append((-1, STRETCH))
    found += [(ord(c) - 96, SWAP) for c in LOOKALIKES.get(char, "")]
    if char == " ":  # only between letters that are spelled out
        found += [(0, 0.0), (-1, DROP)]
    if char in LOOKALIKES:
        found.append((-1, WILD))
    return found or [(0, 0.0)]


def _wildcard(states: dict[int, tuple[float, str]], opened, costs) -> tuple[dict[int, tuple[float, str]], set[int]]:
    """The states after one more wildcard, and those it made cheaper.

    Only ``opened`` states can lead to cheaper ones: the others were tried at an earlier wildcard of the run. Once no
    state becomes cheaper none ever will, so the rest of a run, however long, changes nothing. As each letter costs more
    than leaving its mark out and the model's costs are bounded, that is after a few wildcards.
    """
    following, cheaper = dict(states), set()
    for state in opened:
        cost, letters = states[state]
        cost += WILD - DROP
        for code in range(1, LETTERS):
            at = state * LETTERS + code
            new, total = at % LETTERS**3, cost + costs[at]
            if new not in following or total < following[new][0]:
                following[new] = (total, letters + chr(96 + code))
                cheaper.add(new)
    return following, cheaper


def decode(word: str, costs) -> str:
    """The letters that a disguised word most likely stands for."""
    # State: last three letter codes. Each keeps its least cost and the letters so far.
    states = {0: (0.0, "")}
    before = ""
    wild: set[int] | None = None  # states that the last wildcard made cheaper
    for char in word:
        if char in SEPARATORS:
            # Leaving it out costs the same in every state and decides nothing, so that cost is not counted.
            if char == "*" and wild != set():
                states, wild = _wildcard(states, states.keys() if wild is None else wild, costs)
            before = char
            continue
        wild = None
        following: dict[int, tuple[float, str]] = {}
        options = _options(char, before)
        if len(states) == 1 == len(options) and options[0][0] >= 0:
            # One way only, as in most of most words.
            ((state, (cost, letters)),), ((code, channel),) = states.items(), options
            at = state * LETTERS + code
            states, before = {at % LETTERS**3: (cost + channel + costs[at], letters + (chr(96 + code) if code else " "))}, char
            continue
        for state, (cost, letters) in states.items():
            for code, channel in options:
                if code < 0:
                    new, total, out = state, cost + channel, letters
                else:
                    total = cost + channel + costs[state * LETTERS + code]
                    new, out = (state * LETTERS + code) % LETTERS**3, letters + (chr(96 + code) if code else " ")
                if new not in following or total < following[new][0]:
                    following[new] = (total, out)
        states, before = following, char
    return min((cost + costs[state * LETTERS], letters) for state, (cost, letters) in states.items())[1].strip()


class Restorer:
    """Turns a text into the set of its plain and restored words."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs.tolist()  # read one by one
        self.known: dict[bytes, tuple[bytes, ...]] = {}

    def restored(self, token: bytes) -> tuple[bytes, ...]:
        """What a disguised token may stand for."""
        key, forms = token, self.known.get(token)
        if forms is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            # A long closing run of one mark is decoration.
            for char, byte in _FOLDED.items():
                token = token.replace(byte, char)
            whole = token.decode("utf-8", "replace")
            body = _CLOSING.sub("", whole.strip("\"'`,;:?()[]{}<>&#%/\\="))
            # With and without the marks at its ends: they may be letters or punctuation.
            spelled = {_CLOSING.sub("", whole.strip("\"`,;:?)[]{}<>&#%/\\=")), body, body.strip(_EDGES)}
            forms = tuple({w.encode() for s in spelled for w in ([s] if _CERTAIN.fullmatch(s) else decode(s, self.costs).split())})
            self.known[key] = forms
        return forms

    def words(self, raw: bytes) -> set[bytes]:
        found = set(raw.translate(_PLAIN).split())
        lowered = raw.translate(_LOWER)
        for char, byte in _FOLDED.items():
            lowered = lowered.replace(char, byte)
        text = np.frombuffer(lowered, np.uint8)
        if not len(text):
            return found
        letters, odd = np.zeros(len(text) + 1, np.int64), np.zeros(len(text) + 1, np.int64)
        np.cumsum(_LETTER[text], out=letters[1:])
        opened = _MARK[text]
        opened[1:] |= (text[:-1] == text[1:]) & _ASCII[text[1:]]
        np.cumsum(opened, out=odd[1:])
        starts, ends = word_spans(text)
        at = (letters[ends] > letters[starts]) & (odd[ends] > odd[starts])
        for token in {lowered[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())}:
            found.update(self.restored(token))
        if self._spelled(text):
            for spelled in _SPELLED.finditer(lowered):
                run = spelled[0].translate(None, _GAPS)
                if len(run) >= 4 or any(97 <= c <= 122 for c in run):
                    for joined in {run, *(even[0].replace(even[1], b"") for even in _EVEN.finditer(spelled[0]))}:
                        found.add(joined)
                        found.update(self.restored(joined))
                    found.update(self.restored(b" ".join(run[i : i + 1] for i in range(len(run)))))
        return found

    @staticmethod
    def _spelled(text: np.ndarray) -> bool:
        """Whether two single letters stand with nothing but a gap between them."""
        joined = np.zeros(len(text) + 2, bool)
        joined[1:-1] = _JOINED[text]
        alone = np.flatnonzero(_SINGLE[text] & ~joined[:-2] & ~joined[2:])
        other = np.zeros(len(text) + 1, np.int64)
        np.cumsum(~_GAPPED[text], out=other[1:])
        return bool(((other[alone[1:]] == other[alone[:-1] + 1]) & (np.diff(alone) > 1)).any())


def word_weights(sample: DataFrame, costs: np.ndarray, max_words: int = MAX_WORDS) -> tuple[dict[str, float], float]:
    """Weights of telling words and the base score, from ``(doc_id, text, label)`` rows."""
    shared = sample.sparkSession.sparkContext.broadcast(costs)

    def run(parts):
        restorer = Restorer(shared.value)
        for part in parts:
            words, labels = [], []
            for raw, label in zip(part.column("raw"), part.column("label")):
                own = restorer.words(raw.as_py())
                words += [w.decode("utf-8", "replace") for w in own]
                labels += [label.as_py()] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())], names=["word", "label"])

    rows = sample.select(utf8("text").alias("raw"), F.col("label").cast("int").alias("label"))
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones")).collect()[0]
    n, ones = totals["n"], totals["ones"]
    if not n:
        return {}, -math.inf
    counted = rows.mapInArrow(run, "word string, label int").groupBy("word").agg(F.count("*").alias("all"), F.sum("label").alias("hits"))
    often = counted.filter(F.col("hits") >= 3).filter(F.col("hits") * n > 3 * F.col("all") * ones)
    # The sample is bounded, so its words are: a million rows of text at most come back as counts.
    ranked = often.orderBy(F.col("hits").desc(), F.col("all"), "word").limit(20 * max_words).collect()
    enough = 2 * math.log(max(2, n)) + 6
    rate = ones / n
    found = []
    for row in ranked:
        hits, misses = row["hits"], row["all"] - row["hits"]
        ratio = 2 * (hits * math.log(hits / (row["all"] * rate)) + (misses * math.log(misses / (row["all"] * (1 - rate))) if misses else 0))
        if ratio >= enough:
            odds = ((hits + 0.5) / (ones - hits + 0.5)) / ((misses + 0.5) / (n - ones - misses + 0.5))
            found.append((ratio, row["word"], math.log(odds)))
    best = {word: weight for _, word, weight in sorted(found, reverse=True)[:max_words]}
    telling = sample.sparkSession.sparkContext.broadcast((costs, {w.encode() for w in best}))

    def without(parts):
        shared_costs, words = telling.value
        restorer = Restorer(shared_costs)
        for part in parts:
            plain = [not words & restorer.words(raw.as_py()) for raw in part.column("raw")]
            yield pa.RecordBatch.from_arrays([pa.array(plain, pa.bool_()), part.column("label")], names=["plain", "label"])

    rest = rows.mapInArrow(without, "plain boolean, label int").filter("plain").agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones")).collect()[0]
    base = (rest["ones"] + 0.5) / (rest["n"] + 1)
    return best, math.log(base / (1 - base))


def score(docs: DataFrame, model: tuple[np.ndarray, dict[str, float], float], idx: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted, restored)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        costs, weights, base = shared.value
        restorer, telling = Restorer(costs), {w.encode(): w for w in weights}
        for part in parts:
            values, why = [], []
            for raw in part.column("raw"):
                own = sorted(telling[w] for w in telling.keys() & restorer.words(raw.as_py()))
                # Sorted, so that the sum does not depend on the order of a set.
                values.append(logistic(base + sum(weights[w] for w in own)))
                why.append(" ".join(own))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.float64()), pa.array(why, pa.string())], names=["doc_id", "score", "restored"])

    rows = docs.select(F.col(idx).cast("long").alias("doc_id"), utf8(text).alias("raw"))
    scored = rows.mapInArrow(run, "doc_id long, score double, restored string")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "restored"
    )


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, dict[str, float], float], text: str = "text") -> DataFrame:
    """The documents that score below the threshold, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        costs, weights, base = shared.value
        restorer, telling = Restorer(costs), {w.encode(): w for w in weights}
        for part in slices(parts):
            keep = []
            for body in part.column(text):
                own = sorted(telling[w] for w in telling.keys() & restorer.words((body.as_py() or "").encode()))
                keep.append(logistic(base + sum(weights[w] for w in own)) < THRESHOLD)
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def logistic(total: float) -> float:
    return 0.0 if total == -math.inf else 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))


def fit(docs: DataFrame, labels: DataFrame, idx: str = "doc_id", text: str = "text") -> tuple[np.ndarray, dict[str, float], float]:
    costs = language_model(docs, text)
    weights, base = word_weights(training_sample(docs, labels, "toxic", TRAIN_ROWS, idx, text), costs)
    return costs, weights, base


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
