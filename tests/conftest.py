import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pixelframe.session import get_spark
    s = get_spark("local[4]", app="pixelframe-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s
    s.stop()


@pytest.fixture(autouse=True, scope="module")
def _scratch(spark):
    """Scratch tables and folders end with the module that made them."""
    yield
    from pixelframe.session import release_scratch
    release_scratch(spark)
