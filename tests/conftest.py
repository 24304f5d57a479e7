import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from vacancylens.session import build_session
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="vacancylens-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
