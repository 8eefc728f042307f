import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [sys.path[0], os.environ.get("PYTHONPATH")]))  # for Python workers

from pricewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="pricewright-") as shared:
        session = local_session(8, shuffle_partitions=4, shared=f"file://{shared}")
        session.sparkContext.setLogLevel("ERROR")
        yield session
        session.stop()
