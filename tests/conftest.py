import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
sys.path.insert(0, ROOT)
sys.path.insert(0, HERE)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from brandlink.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=4,
                  extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()
