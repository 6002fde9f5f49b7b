import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from legwork.session import apply_defaults, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = apply_defaults(local_session("legwork-tests", "8"))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
