import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from labwire.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="labwire-tests")
    # tests run without a cluster: a private checkpoint folder
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="labwire-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="labwire-test-")
