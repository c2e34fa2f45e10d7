"""Rows that every operator has to cope with."""

import pytest

LONG = "lorem ipsum dolor sit amet " * 8000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, {extra}"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, ties."""
    return [
        (1, None, "en", "src0", 0, "x"),
        (2, "", None, "src0", 0, None),
        (3, " \t\n ", "en", None, None, "x"),
        (4, LONG, "en", "src1", len(LONG), "x"),
        (5, "one two three four five six", "en", "src1", 27, "x"),
        (5, "one two three four five six", "en", "src1", 27, "x"),
        (6, "one two three four five six", "de", "src2", 27, "x"),
        (None, "one two three four five six", "en", "src2", 27, "x"),
        (None, None, None, None, None, None),
        (7, "12345 !!! ???", "en", "src3", 13, "x"),
        (8, "Üñïçødé ß ſ K 漢字 \U0001f600 done", "de", "src0", 20, "x"),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    """A function: the odd rows with an extra column of the given name."""

    def make(extra="extra_col", rows=odd_rows):
        return spark.createDataFrame(rows, SCHEMA.format(extra=f"`{extra}` string"))

    return make


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
