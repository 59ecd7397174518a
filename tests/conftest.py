import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from tessel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, 4, "tests", **{"spark.driver.memory": "4g"})
    yield s
    s.stop()
