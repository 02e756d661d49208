import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from dialoom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", shuffle_partitions=3)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
