import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with the other columns of the table."""

    def made(rows):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(rows, DOCS)

    return made


@pytest.fixture(scope="session")
def clashing():
    """The frame with extra columns whose names operators use for results or on the way."""

    def added(df, *names):
        return df.select("*", *[F.lit(f"extra {name}").alias(name) for name in names])

    return added
