import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, row string, key string, start int, sequence_id long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and white texts, repeated rows, a very long text, and columns whose names the operators use."""
    rnd = random.Random(7)
    long_text = " ".join(rnd.choice("the of and zuper mega flurb, Wort. naïve".split()) + str(rnd.randrange(9)) for _ in range(20_000))
    texts = [(1, "Hello the World, of 12 cafés!"), (2, ""), (3, None), (4, " \t\n "), (5, "Hello the World, of 12 cafés!"), (6, long_text), (None, "no id here"), (7, "a"), (7, "a"), (8, "<|endoftext|> x  y \n z<|startoftext|>"), (9, "漢字 😀 é́"), (10, "x" * 5000)]
    rows = [(i, t, None if i in (2, None) else "en", None, None, None, None, "r", None, None, None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
