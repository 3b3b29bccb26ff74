import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    session.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    yield session
    session.stop()
