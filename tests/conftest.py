import os
import sys
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("LAYERFLOW_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from layerflow.session import build_session
    # spark.checkpoint.dir comes from the session's configuration; the
    # library sets a private folder only when it is unset
    s = build_session(master="local[4]", shuffle_partitions=8, app="layerflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
