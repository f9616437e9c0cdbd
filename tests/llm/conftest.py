import pytest

ODD = "doc_id long, text string, lang string, source string, n_chars long, id long, token string, n long, h1 long, kept string, batch int, row string, best int, slice int"
TEXT = "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf again"
LONG = " ".join(f"{TEXT} {i}" for i in range(3_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    text = TEXT
    rows = [
        (1, text, "en", "src0"),
        (2, text, "en", "src0"),
        (2, text, "en", "src0"),
        (3, None, None, None),
        (4, "", "de", "src1"),
        (5, "   \n\t ", "fr", "src1"),
        (6, LONG, "en", "src2"),
        (7, LONG + " end", "en", "src2"),
        (8, "12345 !!! 67890", "en", "src0"),
        (None, "the lazy dog runs over the big fox and jumps away from the bad wolf", "en", "src3"),
        (9, "one\n" * 5 + text, "xx-YY", "src0"),
    ]
    return spark.createDataFrame([(*r, 1, 7, "t", 3, 4, "k", 5, "r", 6, 8) for r in rows], ODD)
