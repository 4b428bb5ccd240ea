import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def sample(spark):
    import sample_ledger

    return sample_ledger.tables(spark)
