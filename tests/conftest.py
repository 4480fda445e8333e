import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemill.session import local_session

    session = local_session("tests", cpus=4, memory="4g", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
