import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def tables(spark, tmp_path):
    """Write small tables as a folder of Parquet files."""

    def write(**frames):
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def documents(spark):
    def make(texts):
        rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
        return spark.createDataFrame(rows, DOCS)

    return make
