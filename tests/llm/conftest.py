import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of small document tables: (doc_id, text[, lang[, source]]) rows."""

    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"clash {c}") for c in extra})
        return df

    return make


@pytest.fixture(scope="session")
def whole(spark):
    """The documents of the smallest test tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
