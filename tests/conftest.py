import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from covenant.session import checkpoint_root, local_session

    s = local_session(cores=4, shuffle_partitions=4, app="covenant-tests")
    checkpoint_root(s)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
