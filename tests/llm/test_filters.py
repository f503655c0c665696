import itertools
import time

import numpy as np
import pytest
from helpers import awkward, got, prose, table
from pyspark.sql import functions as F

from corpusml.llm import decontamination, quality, toxicity
from corpusml.llm.labels import held_out, training_sample

FOLDER = "/root/testdata/sf0.01"


def area(scored, label):
    rows = [(r["score"], r[label]) for r in scored.collect()]
    ones, zeros = [s for s, y in rows if y], [s for s, y in rows if not y]
    return np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros])


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_quality_on_the_held_out_fold(spark, real):
    scored = quality.classify(*real).join(real[1], "doc_id").filter("held_out")
    assert area(scored, "quality") > 0.97
    assert scored.filter("predicted = quality").count() > 0.95 * scored.count()


def test_toxicity_on_the_held_out_fold(spark, real):
    scored = toxicity.classify(*real).join(real[1], "doc_id").filter("held_out")
    # One label in twenty is noise; without it the words decide.
    assert scored.filter("predicted = toxic").count() > 0.93 * scored.count()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows(spark, module):
    rows = awkward()
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)] + [(None, 1, 1), (1, None, None), (2, 7, 7)], "doc_id long, quality int, toxic int")
    scored = module.classify(table(spark, rows), labels)
    assert len(rows) == scored.count() and scored.filter("score >= 0 AND score <= 1").count() == len(rows)
    nothing = spark.createDataFrame([], labels.schema)
    assert module.classify(table(spark, rows), nothing).count() == len(rows)
    assert module.classify(table(spark, []), labels).count() == 0


def test_the_held_out_fold_is_not_learned(spark):
    docs = table(spark, [(i, f"t{i}", "en", "a", 1) for i in range(50)])
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, toxic int")
    sample = training_sample(docs, labels, "toxic", 1000)
    assert sample.filter(held_out("doc_id")).count() == 0
    assert sample.count() == docs.filter(~held_out("doc_id")).count() < 50
    assert training_sample(docs, labels, "toxic", 7).count() == 7


def restorer(more=""):
    text = " ".join([prose(1, 300), "idiot stupid worthless clown moron trash loser " * 30, more])
    codes = toxicity._CODE[np.frombuffer(b"\n\n\n" + text.encode() + b"\n\n\n", np.uint8)]
    runs = ((codes[:-3] * 27 + codes[1:-2]) * 27 + codes[2:-1]) * 27 + codes[3:]
    seen, n = np.unique(runs, return_counts=True)
    return toxicity.Restorer(toxicity.letter_costs(seen, n))


@pytest.mark.parametrize("written, word", [
    ("1d10t", "idiot"), ("!d!ot", "idiot"), ("id*ot", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("stuuupid", "stupid"),
    ("s7upid!!", "stupid"), ("cl0wn,", "clown"), ("m-o-r-o-n", "moron"), ("7r4sh", "trash"), ("L0SER", "loser"), ("IDIOT!!", "idiot"), ("tra-sh", "trash"),
])
def test_disguised_words(written, word):
    assert word.encode() in restorer().words(f"some {written} here".encode())


@pytest.mark.parametrize("written, word", [
    ("idio+", "idiot"), ("trash|", "trash"), ("dum8", "dumb"), ("id¡ot", "idiot"), ("los€r", "loser"), ("£oser", "loser"), ("stuupid", "stupid"),
    ("iiddiioot", "idiot"), ("(lown", "clown"), ("(idiot)", "idiot"), ("i  d  i  o  t", "idiot"), ("i-d_i.o t", "idiot"), ("i. d. i. o. t.", "idiot"),
    ("a m.o.r.o.n", "moron"), ("a m o r o n", "moron"), ("i\nd\ni\no\nt", "idiot"), ("£ o s e r!", "loser"), ("d u m 8", "dumb"),
])
def test_the_gate_is_as_wide_as_the_lattice(written, word):
    known = restorer("a dumb thing is a moron " * 30)
    assert word.encode() in known.words(f"some {written} here".encode()) and word.encode() in known.words(written.encode())


def exhaustive(word, costs):
    """The cheapest of all readings of a word, one by one."""
    options, before = [], ""
    for char in word:
        if char in toxicity.SEPARATORS:
            options.append([(-1, toxicity.DROP)] + [(c, toxicity.WILD) for c in range(1, 27) if char == "*"])
        else:
            options.append(toxicity._options(char, before))
        before = char
    best = (float("inf"), "")
    for reading in itertools.product(*options):
        cost, state = 0.0, 0
        for code, channel in [*reading, (0, 0.0)]:
            cost += channel
            if code >= 0:
                cost += costs[state * 27 + code]
                state = (state * 27 + code) % 27**3
        best = min(best, (cost, "".join(chr(96 + c) if c else " " for c, _ in reading if c >= 0)))
    return best[1].strip()


@pytest.mark.parametrize("word", ["id*ot", "1d!0t", "m**on", "***er", "*-*n", "s*u*!d", "stuup1d", "l-o.s|r", "i d i 0 t", "*", "**", "t*.*sh", "c*o*n", "(l0wn", "a1a2", "£0s€r"])
def test_the_decoder_against_all_readings(word):
    costs = restorer().costs
    assert toxicity.decode(word, costs) == exhaustive(word, costs)


def test_long_runs_of_wildcards():
    known = restorer()
    for divider in ("*" * 10_000, "*-" * 10_000):
        for written in (f"{divider}note", f"x{divider}y"):
            started = time.monotonic()
            known.words(written.encode())
            assert time.monotonic() - started < 30
    assert toxicity.decode("*" * 40 + "note", known.costs) == toxicity.decode("*" * 80 + "note", known.costs)


def test_repeated_ids_do_not_add_to_the_sample(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    docs = table(spark, [(1, t, "en", "a", 1) for t in ("b", "a", None)] * 50 + [(2, None, "en", "a", 1), (None, "x", "en", "a", 1)])
    assert got(training_sample(docs, labels, "toxic", 10), "doc_id", "text", "label") == [(1, "a", 1), (2, None, 0)]
    assert docs.select(held_out("doc_id").alias("h")).filter("h IS NULL").count() == 0


def test_two_letters_are_decoded():
    assert b"no" in restorer("no " * 30).words(b"n0") and b"no" in restorer("no " * 30).words(b"n o")
    assert restorer().words(b"") == set() and restorer().words(b"12.5 (7)") == set()


def test_letter_counts_cover_all_texts(spark):
    docs = table(spark, [(1, "abca", "", "", 1), (2, None, "", "", 1), (3, "ABCA é", "", "", 1)])
    counts = dict(got(toxicity.count_letters(docs, "text"), "run", "n"))
    code = lambda s: sum((ord(c) - 96 if c != " " else 0) * 27 ** (3 - i) for i, c in enumerate(s))
    assert counts[code("abca")] == 2 and counts[code("  ab")] == 2 and counts[code("ca  ")] == 2


def brute_tokens(text):
    import re
    import unicodedata

    seen = re.sub("[\u00ad\u200b-\u200f\u2060\ufeff]", "", unicodedata.normalize("NFC", text).lower())
    return re.findall(r"[^\W_]+", seen)


def brute_tiles(a, b, least=None):
    """Greedy string tiling by the book, on token lists."""
    least = least or min(5, len(b))
    used_a, used_b = [False] * len(a), [False] * len(b)
    tiles = []
    while b:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = n, i, j
        n, i, j = best
        if n < least:
            break
        used_a[i : i + n] = [True] * n
        used_b[j : j + n] = [True] * n
        tiles.append((i, j, n))
    return tiles


def brute_coverage(text, item):
    b = brute_tokens(item)
    return sum(n for *_, n in brute_tiles(brute_tokens(text), b)) / max(1, len(b))


def test_decontamination_against_brute_force(spark):
    item = prose(5, 30)
    w = item.split()
    short = "to be or"
    texts = [
        prose(6, 40) + " " + item + " " + prose(7, 40), " ".join(w[15:] + ["x"] + w[:15]), " ".join(w[:10]), " ".join(w[:16]), item.upper(),
        " ".join(w[20:] + ["y"] + w[10:20] + ["z", "z"] + w[:10]), ", ".join(w), short, None, "", " ".join(w[:6] * 5), prose(8, 90), item + " " + item,
        "not TO BE, or be", "to be be or", item,
    ]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)] + [(None, item, "en", "a", 1)]
    items = [(1, item), (2, short), (3, None), (4, ""), (5, prose(99, 40)), (1, item), (None, item.upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = got(decontamination.contaminated(table(spark, rows), bench), "doc_id", "item_id")
    wanted = [(r[0], i) for r in rows for i, t in items if r[1] and t and brute_coverage(r[1], t) >= decontamination.COVERAGE]
    assert sorted(found, key=str) == sorted(wanted, key=str) and (7, 2) in wanted and (13, 2) in wanted and (0, None) in wanted
    clean = decontamination.clean(table(spark, rows), bench)
    assert clean.columns == table(spark, rows).columns
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows} - {d for d, _ in wanted}
    nothing = bench.filter("false")
    assert decontamination.clean(table(spark, rows), nothing).count() == len(rows)
    assert decontamination.contaminated(table(spark, []), bench).count() == 0


def test_characters_beyond_ascii(spark):
    item = prose(5, 30)
    w = item.split()
    quoted = " ".join(f"\u201c{x}\u201d" if i % 4 == 0 else x for i, x in enumerate(w))
    accents = "\u00e9l\u00e8ve na\u00efve \u00fcber stra\u00dfe \u0436\u0443\u043a ga\u0308r sei und wo da"
    texts = ["\u00a0".join(w), quoted, " \u2014 ".join(w), "\u2013".join(w), " ".join(x[:1] + "\u00ad" + x[1:] for x in w), accents.upper().replace("SS", "\u00df"),
             accents.replace("a\u0308", "\u00e4"), prose(9, 40) + " \u00e9"]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    bench = spark.createDataFrame([(1, item), (2, accents)], "item_id long, text string")
    assert got(decontamination.contaminated(table(spark, rows), bench), "doc_id", "item_id") == [(i, 1) for i in range(5)] + [(5, 2), (6, 2)]


def test_many_items_and_a_phrase_they_share(spark):
    phrase = "what is the right answer to the question about"
    items = [(i, phrase + " " + prose(i, 12)) for i in range(3000)]
    rows = [(i, prose(5000 + i, 5) + " " + t, "en", "a", 1) for i, t in items[::10]] + [(9000 + i, f"{phrase} {prose(9000 + i, 20)}", "en", "a", 1) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = got(decontamination.contaminated(table(spark, rows), bench), "doc_id", "item_id", "tokens")
    assert found == sorted(((i, i, 21) for i in range(0, 3000, 10)), key=lambda r: str(r[0]).zfill(9))


def seeds(a, b, least):
    ours, theirs = {}, {}
    for words, side in ((a, ours), (b, theirs)):
        for i in range(len(words) - least + 1):
            side.setdefault(tuple(words[i : i + least]), []).append(i)
    runs = sorted(ours.keys() & theirs.keys())
    return [ours[r] for r in runs], [theirs[r] for r in runs]


def test_tiles_against_brute_force():
    rng = np.random.default_rng(3)
    for case in range(300):
        letters = "ab" if case % 2 else "abcdef"
        a, b = ([letters[x] for x in rng.integers(0, len(letters), rng.integers(0, 40))] for _ in range(2))
        if case % 3 == 0:
            a = a[:5] + b[7:] + a[5:] + b[:9]
        least = int(rng.integers(1, 6))
        assert decontamination.tile(*seeds(a, b, least), least) == brute_tiles(a, b, least)


def test_a_million_equal_tokens(spark):
    started = time.monotonic()
    docs = table(spark, [(1, "la " * 1_000_000, "en", "a", 1), (2, "la " * 49, "en", "a", 1), (3, "la " * 50, "en", "a", 1)], clashes=False)
    bench = spark.createDataFrame([(1, "la " * 100)], "item_id long, text string")
    assert got(decontamination.contaminated(docs, bench), "doc_id", "coverage", "tiles", "tokens") == [(1, 1.0, 1, 100), (3, 0.5, 1, 50)]
    assert time.monotonic() - started < 30


def test_filters_keep_columns(spark):
    rows = awkward()
    model = (toxicity.letter_costs(np.zeros(0, int), np.zeros(0)), {"one": 50.0}, -3.0)
    kept = toxicity.keep_clean(table(spark, rows), model)
    assert kept.columns == table(spark, rows).columns
    assert kept.filter(F.col("doc_id") == 6).count() == 0 and kept.count() == len(rows) - 2
