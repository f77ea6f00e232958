import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from lockgate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "lockgate-tests",
        cores=4,
        memory="4g",
        shuffle_partitions=4,
        **{
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lockgate-tests-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lockgate-warehouse-"),
        },
    )
    yield session
    session.stop()
