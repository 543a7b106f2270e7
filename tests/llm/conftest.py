import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table like ``documents`` from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(rows):
        full = [(*row, None, None)[:4] if len(row) == 2 else row for row in rows]
        return spark.createDataFrame([(*row, len(row[1] or "")) for row in full], "doc_id long, text string, lang string, source string, n_chars long")

    return build


#: Columns whose names operators use inside.
CLASHES = ["row", "id", "mix", "n", "size", "token", "rep", "word", "key", "rate", "shingles", "score", "of", "component", "_words", "bits"]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    return [
        (1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "en", "a"), (4, "word", "en", "a"), (4, "word", "en", "a"),
        (5, "One two three four five six seven.", "en", "b"), (6, "one two  three four five\nsix seven.", "en", None),
        (None, "one two three four five six seven.", "fr", "b"), (7, "long " * 30_000, "fr", "c"), (8, "x" * 50_000, "fr", "c"),
        (9, "12 34 !! ..", "en", "a"), (10, "été à la mer ñandú 中文 🙂", "fr", "b"), (11, "nul \x00 byte", "en", "b"),
    ]


@pytest.fixture(scope="session")
def odd_docs(docs_of, odd_rows):
    from pyspark.sql import functions as F

    docs = docs_of(odd_rows)
    return docs.select("*", *(F.lit(f"clash {name}").alias(name) for name in CLASHES))
