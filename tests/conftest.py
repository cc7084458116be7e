import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudloom import schemas  # noqa: E402
from fraudloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tx_of(spark):
    """Transactions from (card, ts_ms, seq, amount[, dest]) tuples."""
    def build(*events):
        rows = []
        for card, ts, seq, amount, *dest in events:
            rows.append((
                1, "PAYMENT", float(amount), card, 0.0, 0.0, dest[0] if dest else "M00x",
                0.0, 0.0, 0, 0, ts, seq,
            ))
        return spark.createDataFrame(rows, schemas.SEQUENCED)
    return build
