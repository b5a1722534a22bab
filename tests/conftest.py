from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pos360.session import drop_written_tables, ensure_checkpoint_dir, local_session

    s = local_session(cores="*", shuffle_partitions=8, driver_memory="8g", app_name="pos360-tests")
    ensure_checkpoint_dir(s)
    yield s
    drop_written_tables(s)
    s.stop()
