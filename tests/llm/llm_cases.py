"""Small tables with every awkward case."""

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, fingerprint STRING, node STRING, h BIGINT, sig BIGINT, _row STRING"


def syllables(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mir", "tes", "un", "dra", "phe", "zo"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward_texts():
    rng = random.Random(4)
    long = syllables(rng, 30_000)
    a, b = syllables(rng, 120), syllables(rng, 90)
    return [None, "", "   \n\n ", "x", "one two", "Émile été ñandú 你好 𝄞 clef", a, a, a.replace("ka", "ke", 2), b, b + "\n" + a, long, long + " tail", "!!! ??? ...", "\0\1 control", "no newline at end\n"]


def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, equal ids with different texts, clashing column names."""
    rows = [(k, t, "en", "s", len(t or ""), "f", "n", 1, 2, "r") for k, t in enumerate(awkward_texts())]
    rows += [rows[6], rows[6], (6, "another text under the same id", None, None, None, None, None, None, None, None), (None, "text without id", None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
