import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keelson.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, conf={"spark.driver.memory": "4g"})
    yield s
    s.stop()
