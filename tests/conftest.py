import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]
os.environ.setdefault("TIDELINE_DRIVER_MEMORY", "6g")

from tideline.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=2, app="tests")


@pytest.fixture(scope="session")
def data():
    return DATA
