import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from revlens.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    wh = tempfile.mkdtemp(prefix="revlens-wh-")
    s = get_spark("local[*]", shuffle_partitions=8,
                  extra_conf={"spark.driver.memory": "8g", "spark.sql.warehouse.dir": wh})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
