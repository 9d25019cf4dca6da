import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.session import test_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = test_session()
    yield session
    session.stop()
