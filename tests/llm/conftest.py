import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, n_words string, score string"


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Ids and texts with copies, near copies, shared passages, nulls, empties, repeats, one long text."""
    base, passage = words(200, 1), words(90, 2)
    edited = base.split()
    edited[100] = "changed"
    rows = [(1, base), (2, base.upper()), (3, " ".join(edited)), (4, base), (4, base), (5, None), (6, ""), (7, " \n\t "), (None, words(80, 3)),
            (8, words(40, 4) + " " + passage + " " + words(60, 5)), (9, words(70, 6) + "\n" + passage + ".\n" + words(10, 7)),
            (10, "one"), (11, "one"), (12, "one two"), (13, "ünïcödé ßtraße 日本語 text — “quoted” 😀 " * 3), (14, "aaaa " * 300),
            (15, words(20_000, 8)), (16, "it's <|endoftext|> can't\x1cstop\x85now 12345"), (17, words(120, 9) + " ***" * 90)]
    return rows + [(100 + i, words(60 + i, 20 + i)) for i in range(30)]


@pytest.fixture(scope="session")
def documents(spark, texts):
    """Those texts with other columns, some named like what operators compute."""
    return spark.createDataFrame([(i, t, None, "s", 3, 7, "x", "y") for i, t in texts], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
