import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text) pairs, with columns whose names operators use
    themselves."""

    def build(pairs, extra=True):
        rows = [(i, t, "en", f"s{(i or 0) % 3}" if i is None or i % 5 else None, None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCS)
        return df.withColumns({c: F.lit(7) for c in ("id", "hash", "norm", "row", "key", "copy", "score", "n", "c")}) if extra else df

    return build


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
    return [(1, "a b c d e f"), (2, None), (3, ""), (4, " \n\t "), (5, "a  b c\td e f"), (5, "a  b c\td e f"), (None, "a b c d e f"), (None, None), (6, long), (7, long + " end"), (8, "Ünïcödé ß 日本 🎉"), (9, "x" * 50_000)]
