import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strollgraph.session import build_session

    session = build_session(
        "local[8]", "tests", **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
            "spark.log.level": "ERROR",
        }
    )
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    yield session
    session.stop()
