import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from logweave.session import get_session

    s = get_session(
        "logweave-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples for comparison."""
    cols = cols or df.columns
    return sorted(tuple(r) for r in df.select(*cols).collect())
