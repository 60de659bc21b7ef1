import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tideframe.session import get_spark

    shared = tmp_path_factory.mktemp("shared")
    s = get_spark(4, 4, **{"spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": str(shared / "warehouse"), "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("OFF")
    yield s


@pytest.fixture()
def sf():
    d = DATA / "sf0.001"
    if not d.exists():
        pytest.skip("no test data here")
    return str(d)
