import datetime as dt

import pytest

from marlstone.session import build_session

AS_OF = dt.date(2024, 2, 1)
NOW = dt.datetime(2024, 2, 1, 6, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def values(df, *cols):
    """Sorted tuples of the wanted columns (all of them by default)."""
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
