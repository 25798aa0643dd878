import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mixcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", app="mixcast-tests", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()
