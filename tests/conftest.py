import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", 8, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""
    def read(df, *columns):
        taken = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in taken.collect()), key=repr)
    return read
