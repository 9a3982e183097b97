import os
import sys

# Threads of numpy's linear algebra do not survive the fork that starts a Spark
# session; tests that multiply matrices after it would hang.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

import pytest  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from featflow.session import local_session

    s = local_session(4, shuffle_partitions=8, app="featflow-tests")
    yield s
    s.stop()
