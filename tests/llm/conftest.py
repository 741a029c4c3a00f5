import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with the other columns filled in and some of clashing names."""

    def make(rows, source="s", **extra):
        data = [(i, t, "en", source if isinstance(source, str) else source[k], len(t or "")) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        from pyspark.sql import functions as F

        for name in ("score", "fp", "_fp", "_k", "hash", "size", "_base", "_spans", "same", "zone", "copies"):
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make


@pytest.fixture(scope="session")
def empty_docs(docs_of):
    return docs_of([(1, "x")]).limit(0)
