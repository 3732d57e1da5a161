import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from heatline.session import build_session
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = build_session("tests", f"local[{os.environ.get('TEST_CPUS', '8')}]", 4, **{
        "spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"
