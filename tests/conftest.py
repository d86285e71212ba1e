from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.01"
SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortia import ensure_checkpoint_dir, get_session
    s = get_session("local[8]", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def events_small(spark):
    from cohortia.sources.events import load_events
    return load_events(spark, SF_SMALL)
