import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallow.session import build_session
    scratch = tempfile.mkdtemp(prefix="tallow-tests-")
    s = build_session("local[4]", app="tallow-tests", shuffle_partitions=4,
                      conf={"spark.checkpoint.dir": scratch,
                            "spark.sql.sources.parallelPartitionDiscovery.threshold": "100000"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tallow.session import shared_dir
    return shared_dir(spark, "test")
