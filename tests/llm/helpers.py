"""Documents for small tests: awkward rows, and columns that clash with names used inside."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "_sha string, row bigint, mark bigint, root bigint, size int, target double, _doc bigint, keep boolean"
)
EXTRA = ("x", 1, 2, 3, 4, 5.0, 6, None)


def frame(spark, rows, partitions=3):
    """``rows``: (doc_id, text, source) each; the other columns are filled in."""
    full = [(i, t, "en", s, None if t is None else len(t), *EXTRA) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, words=60, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


AWKWARD = [
    (1, prose(1), "a"),
    (2, prose(1), "a"),
    (2, prose(1), "b"),
    (3, None, "a"),
    (4, "", None),
    (5, " \t\n\r\x0b\x0c ", "b"),
    (None, prose(1), "a"),
    (None, None, None),
    (6, "one two", "a"),
    (7, "One  TWO", "ä"),
    (7, "one two", "a"),
    (7, "one two", "a"),
    (8, prose(2, 30_000, 5_000), "b"),
    (9, "naïve é 漢字 x " * 3, "c"),
    (10, prose(1)[: len(prose(1)) // 2] + " tail of its own", "c"),
    (-11, prose(3) + " " + prose(1), "c"),
]
