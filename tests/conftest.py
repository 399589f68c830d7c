import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clinspark.session import get_session
    s = get_session("local[*]", app="clinspark-tests", shuffle_partitions=8,
                    extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clinspark-test-")
