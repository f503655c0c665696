"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASHES = ["component_id", "kept", "score", "size", "target", "copies", "row", "spans", "run", "first", "open", "raw", "body", "key", "mix_size", "_id", "label"]


def prose(seed, words=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(words))


def awkward():
    base, other = prose(1), prose(2)
    near = base.replace(base.split()[30], "changed", 1)
    return [
        (0, base, "en", "a", 1), (1, base, "en", "b", 1), (2, near, "en", None, 1), (3, None, None, None, None), (4, "", "en", "a", 0),
        (5, " \t\n\x0b\x0c\r ", "en", "b", 7), (6, "one", "en", "a", 3), (7, "Ünï çödé " * 40, "de", "b", 1), (8, "same same " * 80, "en", "a", 1),
        (9, other + "\n" + base[:200] + "\n" + other[:150], "en", "c", 1), (10, prose(3, 4000), "en", "c", 1), (11, prose(3, 4000)[500:9000] + " end", "en", "c", 1),
        (12, "Same Same " * 30, "en", "b", 1), (13, "x" * 900, "en", "a", 1), (6, "one", "en", "a", 3), (None, other, "en", "a", 1),
    ]


def table(spark, rows, clashes=True):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("extra") for c in CLASHES}) if clashes else df


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((x is not None, str(x).zfill(9)) for x in r))
