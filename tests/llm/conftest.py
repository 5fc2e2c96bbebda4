import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table with given (doc_id, text) rows, other columns with clashing names included."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t), i, t, 1) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, id long, body string, n int",
        )

    return make


@pytest.fixture
def tables(spark, tmp_path):
    """Write frames as the Parquet tables of a folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
