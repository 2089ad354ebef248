import os
import tempfile
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelstar.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="reelstar-tests",
                      warehouse=tempfile.mkdtemp(prefix="reelstar-wh-"))
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def _nothing_cached(spark):
    """Tables that a module caches would replace the scans in the plans of later modules."""
    yield
    spark.catalog.clearCache()
