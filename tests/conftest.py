import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import build_session
    s = build_session("local[4]", app="marketlens-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE
