import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def table():
    """All documents of the smallest scale as (doc_id, text, lang, source, n_chars)."""
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


CLASHING = "block int, head boolean, id long, key string, size int, salt int, `group` int, llm_id int, kept boolean, word string, copies int"

LONG = "the quick brown fox jumps over the lazy dog and runs far away from here " * 900


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, and columns with clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
        (1, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
        (1, "another text of the same document here now", "en", "b", 42),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n ", "en", "a", 4),
        (5, LONG, "en", "a", len(LONG)),
        (6, LONG + "end", "en", None, None),
        (7, "un deux trois quatre cinq six sept", "fr", "c", 34),
        (8, "un deux trois quatre cinq six sept", "fr", "c", 34),
        (None, "a row without an id but with some words", "en", "a", 39),
        (None, "x", None, "a", 1),
        (9, "1234 5678 !!", None, "b", 12),
        (10, "password = hunter2hunter2 and İ token:abc", None, "b", 41),
    ]
    base = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([(*r, *[None] * 11) for r in rows], f"{base}, {CLASHING}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
