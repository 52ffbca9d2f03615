import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use themselves
        *(T.StructField(n, T.StringType()) for n in ("row", "text_hash", "_bytes", "size", "key", "part", "nth", "doc", "h", "toxic")),
    ]
)


def document(doc_id, text, source="s", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), *"abcdefghij")


WORDS = "the of and to in that was for with his from this have are which one you were all her".split()


def prose(seed, words=60):
    """Distinct made-up prose."""
    return " ".join(f"{WORDS[(seed * 7 + k * k) % 20]} {chr(97 + (seed + k) % 26)}{seed}x{k}" for k in range(words // 2))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, and repeated rows."""
    long_text = "\n".join(prose(k, 400) for k in range(150))
    rows = [
        document(1, prose(1)),
        document(2, None),
        document(3, ""),
        document(4, " \n\t "),
        document(5, long_text),
        document(5, long_text),
        document(None, prose(1)),
        document(None, None, None, None),
        document(6, prose(1), None),
        document(7, prose(1), None),
        document(7, prose(7)),
        document(8, "word"),
        document(9, "???!!! \x00 ###"),
        document(10, "\n".join([prose(3), prose(4), prose(8), prose(9)] * 2)),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def settings(monkeypatch):
    """Set a module's figures for one test."""
    return monkeypatch.setattr
