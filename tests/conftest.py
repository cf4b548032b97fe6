import pytest

from meterline.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "meterline-tests", 8, **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "2",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        })
    yield session
    session.stop()
