import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from objectlake.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="objectlake-tests")
    yield s


@pytest.fixture(scope="session")
def cat(spark):
    from objectlake.sampledata import sample_catalog
    return sample_catalog(spark, SMOKE)
