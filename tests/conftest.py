import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from freshet.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def con(data):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in os.listdir(data):
        if name.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{data}/{name}'")
    return connection
