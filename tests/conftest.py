import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallycast import build_session

    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        extra={
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallycast-test-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tallycast-test-warehouse-"),
        },
    )
    yield session
    session.stop()
