import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from streamlens.session import get_session
    s = get_session("local[4]", app="streamlens-tests", shuffle_partitions=8)
    yield s
    s.stop()


def msgs(spark, values, topic="transactions"):
    """Envelope rows from raw message texts."""
    rows = [(f"k{i}", v, topic, i % 3, i // 3, None) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp")
