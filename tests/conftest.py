import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillspan.plans.session import local_session  # noqa: E402
from tillspan.sources.star import star_retail  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return star_retail(spark, SF_DIR)
