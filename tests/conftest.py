import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fareflow.session import get_session
    s = get_session(app="fareflow-tests", master="local[4]", shuffle_partitions=8,
                    extra_conf={"spark.ui.showConsoleProgress": "false",
                                "spark.checkpoint.dir": tempfile.mkdtemp(prefix="fareflow-ckpt-")})
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    """A fresh scratch directory per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="fareflow-test-", dir=str(tmp_path_factory.getbasetemp()))


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def sf_mid():
    return SF_MID
