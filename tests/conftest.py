import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from custvalue.session import get_spark
    s = get_spark("local[4]", app="custvalue-tests", shuffle_partitions=8)
    # tests own their shared folder: set only because it is unset here
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="cv-tests-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from custvalue.session import scratch_path
    return lambda name: scratch_path(spark, name)
