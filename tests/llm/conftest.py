import pytest

from gridloam.llm.shipping import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def odd_documents(spark):
    """NULLs, empty and blank texts, a very long one, repeated rows, and columns named like the operators' own."""
    long = " ".join(f"wort{i % 977}x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "eins zwei drei"), (None, None), (4, "eins zwei drei"), (4, "eins zwei drei"), (5, "123 !!"), (6, long), (7, "x" * 5000)]
    names = ["doc_id", "text", "lang", "score", "key", "row", "kept", "spans", "n_words", "matches", "rank", "piece", "text_key", "host", "id"]
    return spark.createDataFrame([(*r, "de", *range(12)) for r in rows], "doc_id long, text string, lang string, " + ", ".join(f"`{n}` int" for n in names[3:]))
