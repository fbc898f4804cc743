import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from orrery.session import build_session, prepare

    s = prepare(build_session("local[4]", "tests", partitions=4, memory="6g"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
