"""Small documents with every awkward case, shared by the tests of this folder."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use for results or inside
CLASHES = ("score", "class_id", "word", "uid", "size", "x", "piece", "n", "k1", "rank", "held_out", "y", "part", "row")


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def rows(seed=0, n=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = words(rng, rng.randint(1, 120)) + rng.choice([".", "", "!"])
        out.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(text)))
    out.append((n, None, None, None, None))
    out.append((n + 1, "", "en", "a", 0))
    out.append((n + 2, " \n\t ", "en", "a", 4))
    out.append((None, out[3][1], "en", "a", 5))
    out.append((None, None, "en", "a", None))
    out += [out[5]] * 3  # fully repeated rows
    out.append((n + 3, out[7][1], "en", "a", 1))  # an exact copy
    long = words(rng, 30_000)
    out.append((n + 4, long, "en", "a", len(long)))
    out.append((n + 5, "é ü 漢字 ñ 😀 ß.", "fr", "c", 14))
    out.append((n + 6, "x" * 50_000, "en", "a", 50_000))  # one very long word
    return out


def docs(spark, seed=0, n=60):
    return spark.createDataFrame(rows(seed, n), SCHEMA)


def clashing(df):
    """The same rows with extra columns named like the operators' own."""
    for c in CLASHES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
