import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from weft.session import session

    found = session("tests", "local[4]", **{"spark__sql__shuffle__partitions": "4", "spark__ui__showConsoleProgress": "false"})
    found.sparkContext.setLogLevel("OFF")
    yield found
    found.stop()
