import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from touchline.session import get_session
    wh = tempfile.mkdtemp(prefix="touchline-wh-")
    s = get_session("local[*]", shuffle_partitions=3, app_name="touchline-tests",
                    extra={"spark.sql.warehouse.dir": wh, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw001(spark):
    from touchline.plans.fixture import raw_visits_from_events
    return raw_visits_from_events(spark.read.parquet(f"{SF001}/events.parquet")).cache()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="touchline-test-")
