import pytest

from tests.comparing import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
    )
    yield session
    session.stop()
