import random

import pytest

SYLLABLES = ["an", "be", "co", "du", "el", "fi", "go", "hu", "in", "ka"]


def prose(rng: random.Random, n: int, syllables=SYLLABLES) -> str:
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rng = random.Random(11)
    text = prose(rng, 150)
    rows = [(1, text, "en", "a", 1), (2, text, "en", "a", 1), (2, text, "en", "a", 1), (3, None, "en", None, None),
            (4, "", None, "a", 0), (None, text, "en", "a", 1), (None, None, None, None, None),
            (5, " \t\n\n ", "en", "a", 4), (6, "x" * 50_000, "de", "a", 5), (7, prose(rng, 20_000), "de", "b", 9),
            (8, "中文 \U0001f600 éß", "fr", "b", 8), (9, "1 2 3 4 5 6 7", "fr", "b", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: "lit" for c in ("id", "kept", "n_words", "component_id", "rate", "tokens", "chunk", "ids", "score", "band")}
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(v) for c, v in extra.items()})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
