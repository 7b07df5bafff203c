import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """A folder that stands for the one a cluster shares."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
