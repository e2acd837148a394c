import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("VELD_DRIVER_MEMORY", "8g")
    from veld.session import checkpoint_root, get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="veld-tests")
    checkpoint_root(s)          # sets a temp folder only when the session has none
    yield s
    s.stop()
