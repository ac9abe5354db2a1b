import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def docs_of(spark: SparkSession):
    """A documents table from (doc_id, text) pairs, with columns that clash with inner names."""

    def make(rows):
        full = [(i, t, "en", "src", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
