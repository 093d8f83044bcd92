import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskmart.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4",
            "spark.checkpoint.dir": str(base / "checkpoint"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
