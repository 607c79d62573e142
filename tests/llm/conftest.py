import pytest

ROWS = [
    (1, "The cat, the DOG.\nand  a bird", "en", "s1", 5),
    (2, "the cat, the dog. AND a bird", None, None, None),
    (3, None, "en", "s1", 0),
    (4, "", "de", "s2", 0),
    (5, " \t\n\x0b\x0c\r ", "de", "s2", 7),
    (6, "x" * 5000 + " " + "long text without sense. " * 900, "fr", "s1", 1),
    (7, "x" * 5000 + " " + "long text without sense. " * 900, "fr", "s1", 1),
    (None, "a row without key, twice", "en", "s1", 1),
    (None, "a row without key, twice", "en", "s1", 1),
    (8, "repeated row é ü ▁ 漢字 🙂 <|endoftext|>", "en", "s1", 1),
    (8, "repeated row é ü ▁ 漢字 🙂 <|endoftext|>", "en", "s1", 1),
    (9, "Repeated row é ü ▁ 漢字 🙂 <|endoftext|> it's we'll 12.5,.", "en", "s1", 1),
    (10, "T h e c a t", "en", "s1", 1),
    (11, "The cat", "en", "s1", 1),
    (12, "étude naïve Σίσυφος ΣΑΣ İstanbul   nbsp wide", "en", "s1", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_rows():
    return ROWS


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and columns that clash with inner names."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.selectExpr("*", "1 as dig", "'x' as norm", "2 as fp", "3 as row", "array(1) as found", "4 as anchor")


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.where("false")
