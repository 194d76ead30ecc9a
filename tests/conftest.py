import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daybridge.testing import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
