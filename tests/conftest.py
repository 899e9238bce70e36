import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemart.session import build_session

    s = build_session(app="tidemart-tests", master="local[4]", shuffle_partitions=4,
                      driver_memory="4g", checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
