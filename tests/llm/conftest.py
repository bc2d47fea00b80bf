"""Small tables with the cases that every operator has to take."""

import pytest

WORDS = "the quick brown fox jumps over the lazy dog and runs far away from old houses near river banks".split()


def prose(n, step=1, offset=0):
    """n words in an order of their own."""
    return " ".join(f"{WORDS[(i * step + offset) % len(WORDS)]}{(i * i * step + offset) % 97}" for i in range(n))


@pytest.fixture(scope="session")
def hard_documents(spark):
    """Nulls, empty and long texts, repeated rows, ties, clashing columns."""
    rows = [
        (1, "One short text.", "n", 7),
        (2, None, None, None),
        (3, "", "n", 1),
        (4, " \t\n\x0b\f\r ", "n", 1),
        (5, prose(30000, 7), "n", 2),
        (6, prose(60), "n", 3),
        (6, prose(60), "n", 3),
        (7, prose(60).replace(" ", "  \n"), "n", 3),
        (None, prose(60, 3), "n", 4),
        (None, None, "n", 4),
        (8, "café 中文 \U0001f600 <|endoftext|> don't stop\x1cnow", "n", 5),
        (9, prose(45, 5, 3), "n", 5),
        (10, "x " + prose(45, 5, 3) + " y", "n", 5),
        (-11, "a " * 200, "n", 5),
    ]
    schema = "doc_id long, text string, fingerprint string, n_tokens int"
    df = spark.createDataFrame(rows, schema)
    for c in ("digest", "locator", "row", "kept", "k", "h", "own", "input", "component_id", "score", "length", "part"):
        df = df.selectExpr("*", f"'clash' as `{c}`")
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_documents(hard_documents):
    return hard_documents.where("false")
