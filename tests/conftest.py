import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airlens.session import build_session, checkpoint_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="airlens-tests")
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from airlens.session import scratch_dir

    return scratch_dir(spark, "test")
