import pytest

from tessera.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tessera-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def base(spark):
    from tessera.session import scratch

    return scratch(spark, "test")


def rows(df, *order):
    """Rows as tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))
