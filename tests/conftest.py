import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pagelens.session import checkpoint_dir, get_spark
    s = get_spark(master="local[*]", app="pagelens-tests", shuffle_partitions=8)
    checkpoint_dir(s)  # sets a scratch folder only because the session names none
    yield s


@pytest.fixture(scope="session")
def registry():
    from pagelens.plans.registry import load_all
    return load_all()
