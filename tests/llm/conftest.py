import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and odd texts, a repeated row, a repeated id and columns whose names operators use."""
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
    rows = [
        (0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one two"), (5, "one two three"), (5, "one two three"), (6, "One TWO three"),
        (7, "a b c d e " * 30), (8, long_text), (9, "prefix " + long_text), (None, "no id here at all"), (10, "É x y   z\x1cw"), (10, "other text"),
    ]
    wide = [(i, t, None if i == 3 else "en", None if i == 4 else "s", len(t or ""), "x", 1, True) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, hash string, at int, kept boolean")
