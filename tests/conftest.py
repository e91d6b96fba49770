import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from retail_helpers import SMALL


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from keepwell.session import local_session

    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        "tests",
        **{
            "spark.checkpoint.dir": str(folder / "checkpoint"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def env(spark):
    from keepwell.queries import Env

    return Env(spark, SMALL)
