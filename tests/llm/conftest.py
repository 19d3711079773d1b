import pytest

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that an operator might use for columns of its own.
        T.StructField("score", T.StringType()),
        T.StructField("component_id", T.StringType()),
    ]
)

LONG = " ".join(f"word{i % 977} Tail{i % 31}" for i in range(120_000))  # above one megabyte


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y")


def hard_documents():
    """NULLs in any column, empty, blank and very long texts, ties, repeated rows."""
    shared = "The same line in every text"
    rows = [document(i, f"{shared}\nown line number {i} of a text\n\n{shared.upper()}  ", "en", f"s{i % 4}") for i in range(1, 25)]
    rows += [
        document(100, None),
        document(101, ""),
        document(102, " \t\n \r\n"),
        document(103, LONG),
        document(104, LONG + " end"),
        document(105, "Älter   Straße\nÉcole\néCOLE\x0b"),
        document(None, "no id here", "en", None),
        document(None, None, None, None),
        document(106, "no language at all 123", None, None),
        document(107, "1234 5678 --- !!!", "de", "s1"),
        document(108, "twice the same row", "fr", "s2"),
        document(108, "twice the same row", "fr", "s2"),
        document(109, "日本語の文章です 🙂 <|endoftext|> x", "ja", "s3"),
    ]
    return rows


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_documents(), DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
