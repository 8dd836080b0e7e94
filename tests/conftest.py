import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tabreg.session import get_spark
    s = get_spark("local[*]", shuffle_partitions=8,
                  extra={"spark.ui.showConsoleProgress": "false",
                         "spark.driver.memory": "8g"})
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
