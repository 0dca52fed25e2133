from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillwright.config import local_session

    session = local_session("*", shuffle_partitions=8, app_name="tillwright-tests")
    # Tests set their own shared folder (the cluster would name one).
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillwright-tests-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle_harness import duck

    return duck(SF_SMALL)
