"""Small document tables with everything that goes wrong in large ones."""

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows, extra=False):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows; ``extra`` adds columns with names that operators use."""
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in ("row", "score", "node", "label", "spans", "ids", "shard", "n", "k", "words", "hash", "first", "bucket", "own_id", "kept_id", "key_id", "component_id", "all", "first_row")})
    return df


def words(seed, n, vocabulary=200):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def prose(seed, n, vocabulary=200):
    return " ".join(words(seed, n, vocabulary))


AWKWARD = [(None, "a text without an id, token: abcdefgh1"), (900, None), (901, ""), (902, " \t\n "), (903, "one"), (904, "é ç 漢字 \U0001f600 ☃"), (904, "é ç 漢字 \U0001f600 ☃"), (905, "x" * 3000), (906, "!!! ... ???")]
