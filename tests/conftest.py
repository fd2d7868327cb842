import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import session, ship

    s = session("tests", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()
