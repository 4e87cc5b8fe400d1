import pytest


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Writes rows as a table of a fresh folder and returns the folder."""

    def write(name, rows, schema, into=None):
        into = into or str(tmp_path_factory.mktemp("tables"))
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{into}/{name}.parquet")
        return into

    return write


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
