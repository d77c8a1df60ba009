import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and a column whose name clashes."""

    def make(texts, ids=None):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def odd(docs):
    words = " ".join(f"w{i % 977} {i}" for i in range(40_000))
    return docs([None, "", "a", "a", words, "plain text of some words\nand a line", " \t\n ", words], [0, 1, 2, 2, 3, None, 5, 6]).selectExpr("*", "source AS file", "1 AS shard", "2 AS _part", "'x' AS label")
