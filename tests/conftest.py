import pytest

from tidemark.session import build_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", "tests", **{"spark__sql__shuffle__partitions": "2", "spark__driver__memory": "4g", "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
