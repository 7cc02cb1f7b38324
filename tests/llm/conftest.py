import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use inside.
CLASH = ["id", "row_id", "__row", "row", "size", "fp", "kept", "n_tokens", "word", "blob", "spans", "score", "host",
         "copies", "y", "__id", "__doc", "phrase", "terms", "ids", "net", "part"]


@pytest.fixture(scope="session")
def frame(spark):
    def make(texts, sources=None, clash=True):
        rows = [(i, t, "en", (sources or ["a"])[i % len(sources or ["a"])], len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, SCHEMA)
        return df.withColumns({c: F.lit("clash") for c in CLASH}) if clash else df

    return make


@pytest.fixture(scope="session")
def odd_frame(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing names."""
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [(1, "some plain words in a text", "en", "a", 26), (1, "some plain words in a text", "en", "a", 26),
            (2, None, None, None, None), (None, "a text without an id", None, "a", None), (3, "", "en", None, 0),
            (4, " \n\t ", "en", "b", 4), (5, long, "en", "b", len(long)), (6, "é 世界 😀 naïve", "fr", "", 11),
            (7, "x" * 50_000, "en", "b", 50_000), (8, "same same same same same same same same same same same same", "en", "b", 59)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="session")
def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)
