import pytest

from tabwright.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", 4,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().toString()
