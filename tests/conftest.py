import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    wh = tempfile.mkdtemp(prefix="sluice-wh-", dir="/tmp")
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="sluice-tests",
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


def log_df(spark, rows):
    """rows: (topic, partition, offset, value) -> a log-shaped DataFrame."""
    full = [(t, p, o, str(p), v, None, 1_700_000_000_000 + o) for t, p, o, v in rows]
    return spark.createDataFrame(
        full, "topic string, partition int, offset long, key string, value string, "
              "timestamp timestamp_ntz, push_time long")
