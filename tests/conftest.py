import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coclick.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def scratch():
    # a fresh scratch folder per test run; never cleared by the tests
    return tempfile.mkdtemp(prefix="coclick-tests-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    s = build_session(master="local[4]", app="coclick-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "8g",
                             "spark.local.dir": os.path.join(scratch, "local")})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()
