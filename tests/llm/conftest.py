import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), HERE]

from fraudloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("llm-tests", partitions=4)
