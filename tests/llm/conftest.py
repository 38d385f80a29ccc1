import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = ("data", "block", "fp", "key", "features", "shard", "_sub", "_k", "items", "bucket", "kept", "y", "u", "v")


def sentence(rng, n):
    stems = ["the", "of", "and", "tion", "re", "an", "ou", "ble", "é", "Wh", "sh,", "er.", "ñandu", "x1"]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, blanks, a very long text, ties, repeated rows and shared passages."""
    rng = random.Random(5)
    passage = sentence(rng, 30)
    texts = [
        None, "", "   \n\t", "one", "É", "a" * 300, sentence(rng, 60_000), passage, passage + " tail",
        "head " + passage, sentence(rng, 40) + "\n" + passage + "\n" + sentence(rng, 40), "日本語 текст ω " * 20,
        "<|endoftext|> it's NICE... 12 ok", "word " * 400, passage, "Licensed under CC BY-NC 4.0. All rights reserved.",
    ]
    rows = [(i, t, None if i % 3 else "en", None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[8], (len(texts), sentence(rng, 50), "fr", "s", 1)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows, SCHEMA)
    return df.withColumns({c: F.lit("other") for c in CLASHING}).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def null_key_docs(spark):
    return spark.createDataFrame(
        [(None, "some words that repeat for a while " * 5, "en", "s", 3), (None, None, None, None, None),
         (7, "some words that repeat for a while " * 5, "en", "s", 3), (3, "other text of its own", "en", "s", 3)], SCHEMA,
    )
