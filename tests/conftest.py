import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cohortkit.session import local_session, shared_folder
    session = local_session(4, shuffle_partitions=4, app="cohortkit-tests")
    shared_folder(session)
    yield session
    session.stop()


SMOKE = "/root/testdata/sf0.001"
