import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from nimbusframe.session import get_session

    s = get_session("local[4]", app_name="nimbusframe-tests", shuffle_partitions=4,
                    conf={"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="nimbus-test-")
