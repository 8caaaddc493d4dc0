import pytest

from fiberqa.llm.ship import ship

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, score string, component string, bucket string, hash string"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
ROWS = [
    (1, "The cat sat on the mat and looked at the dog all day", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \t\n  ", "fr"),
    (5, "The cat sat on the mat and looked at the dog all day", "en"),
    (5, "The cat sat on the mat and looked at the dog all day", "en"),
    (6, "one", "en"),
    (7, LONG, "de"),
    (8, LONG + " end", "de"),
    (None, "no id here, but text enough for a shingle of five words", None),
    (9, "12345 67890 !!! ???", None),
    (10, "Ünïcödé ▁ 🎉 x\x00y  two  spaces ", "fr"),
]


@pytest.fixture(scope="session")
def sent(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def edge(sent):
    """Odd documents, with columns whose names operators use inside."""
    rows = [(i, t, lang, f"s{n % 3}" if n % 4 else None, None, "k", "s", "c", "b", "h") for n, (i, t, lang) in enumerate(ROWS)]
    return sent.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where("false")
