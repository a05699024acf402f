import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="txlens-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("FATAL")
    yield s
    s.stop()


@pytest.fixture
def tmp_shared(spark):
    """A fresh folder under the shared checkpoint folder."""
    from txlens.session import scratch_path

    return scratch_path(spark, "test")
