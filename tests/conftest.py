import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fairspark.session import local_session  # noqa: E402

# a labelled-points text file (lat,lon,label lines) for the golden tests of
# FIXTURES.md F1; the tests skip when it is not given
POINTS_FILE = os.environ.get("FAIRSPARK_POINTS_FILE", "")


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def points_file():
    if not POINTS_FILE or not os.path.exists(POINTS_FILE):
        pytest.skip("labelled points file not available")
    return POINTS_FILE
