import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weirflow.session import create_session  # noqa: E402
from weirflow.sources.jdbc import JdbcDatabase  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = create_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def derby():
    return JdbcDatabase(
        f"jdbc:derby:memory:test{uuid.uuid4().hex};create=true",
        driver="org.apache.derby.jdbc.EmbeddedDriver",
    )


@pytest.fixture
def sqlite(tmp_path):
    return {
        "driver": "sqlite3",
        "url": str(tmp_path / "tables.db"),
        "connectOptions": '{"timeout": 120}',
    }
