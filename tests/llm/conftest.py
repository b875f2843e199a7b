import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text)."""
    def build(rows):
        return spark.createDataFrame(
            [(d, t, "en", "s", None if t is None else len(t)) for d, t in rows], SCHEMA)
    return build


@pytest.fixture(scope="session")
def corpus(spark, folder):
    """The small given documents, and their rows."""
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    return frame, [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
