import pytest

from tests.oracle import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("4")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return spark


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        found = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(r) for r in found), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
