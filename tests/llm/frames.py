"""Frames with the cases that every text operator must stand."""

import random

ODD = [
    (0, "the quick brown fox jumps over the lazy dog and runs away from the very angry bear in the woods " * 3, "en", "a", 1),
    (1, "the quick brown fox jumps over the lazy dog and runs away from the very angry bear in the woods " * 3, None, None, None),
    (2, "", "en", "a", 0), (3, None, None, "b", None), (4, "   \n\t ", "en", "b", 5), (5, "A", "fr", "b", 1), (None, "no id at all but some text", "en", "c", 2),
    (7, "THE QUICK brown fox jumps over the lazy dog and runs away from the very angry bear in the woods " * 3, "en", "a", 1),
    (8, "x" * 250, "en", "a", 250), (9, "é" * 120 + "\x00" + "ß" * 80, "de", "a", 201), (10, "word " * 3000, "en", "a", 15000), (11, "a b", "en", "a", 3),
    (12, "same", "en", "a", 4), (12, "same", "en", "a", 4), (13, "SAME", "en", "a", 4), (None, None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark, extra=True):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names operators use inside."""
    df = spark.createDataFrame(ODD, SCHEMA)
    if extra:
        for name in ("key", "n", "fp", "digest", "name", "word", "ids", "salt", "a", "b", "part", "kept", "keep_id", "trusted", "score"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df.repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shared_texts(n=120, seed=1):
    """Texts over few letters that share passages of a base text, with some edits."""
    rng = random.Random(seed)
    base = "".join(rng.choice("abcd ") for _ in range(400))
    noise = lambda k: "".join(rng.choice("abcd ") for _ in range(rng.randrange(k)))
    return [(i, noise(60) + base[rng.randrange(60) : rng.randrange(150, 400)] + noise(60)) for i in range(n)]
