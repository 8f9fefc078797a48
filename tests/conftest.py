import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TEST_SF = os.environ.get("TALLY_TEST_SF", "0.001")
SF_DIR = f"/root/testdata/sf{TEST_SF}"


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import local_session
    s = local_session("*", shuffle_partitions=8, app_name="tallyspark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
